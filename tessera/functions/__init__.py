"""tessera.functions"""
