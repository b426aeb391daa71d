"""Operators for preparing large text corpora: filtering, deduplication,
scanning, mixing and encoding.  Nothing else in the library imports this
subpackage."""
