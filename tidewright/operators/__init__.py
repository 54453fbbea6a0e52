"""tidewright.operators"""
