"""Operators for preparing language-model training data.

One module per operator; ``queries`` holds the registered queries and
``oracles`` their DuckDB SQL. Nothing outside this folder imports it.
"""
