"""tidewright.streaming"""
