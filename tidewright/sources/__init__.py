"""tidewright.sources"""
