"""folioforge.queries"""
