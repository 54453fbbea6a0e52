"""tidewright.functions"""
