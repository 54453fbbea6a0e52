"""tidewright.plans"""
