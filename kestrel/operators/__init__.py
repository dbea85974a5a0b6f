"""Relational building blocks. Every function is DataFrame -> DataFrame and stays lazy."""
