"""tessera.operators"""
