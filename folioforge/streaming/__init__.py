"""folioforge.streaming"""
