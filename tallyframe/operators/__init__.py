"""tallyframe.operators"""
