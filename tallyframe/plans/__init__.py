"""tallyframe.plans"""
