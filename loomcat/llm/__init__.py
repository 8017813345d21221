"""Training-data operators: ten independent modules, their queries and their oracle SQL.

Nothing outside this folder imports it, so it can be removed as a whole.
"""
