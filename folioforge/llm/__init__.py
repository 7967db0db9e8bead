"""folioforge.llm"""
