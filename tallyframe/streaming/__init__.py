"""tallyframe.streaming"""
