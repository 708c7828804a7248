"""tallyframe.sources"""
