"""folioforge.sources"""
