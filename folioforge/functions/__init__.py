"""folioforge.functions"""
