"""folioforge.operators"""
