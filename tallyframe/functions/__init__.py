"""tallyframe.functions"""
