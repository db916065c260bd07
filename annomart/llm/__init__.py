"""Training-data operators.  Nothing else in the library imports this package;
:mod:`annomart.llm.registry` lists its queries and their DuckDB SQL."""
