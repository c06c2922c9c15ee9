"""quarry.streaming"""
