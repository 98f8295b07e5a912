"""Training-data operators.

Nothing else in the library imports this subpackage; ``catalog`` maps the
registered query names to builders and holds their DuckDB SQL.
"""
