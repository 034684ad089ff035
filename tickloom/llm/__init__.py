"""Training-data operators: mixing, encoding, filtering and de-duplication of document tables.

Nothing outside this folder imports it; ``queries.py`` registers its queries.
"""
