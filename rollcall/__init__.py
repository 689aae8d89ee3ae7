"""Analytics over "records with members" on Spark.

A record is anything that lists members: a publication and its authors, an
order and its suppliers, a document and its words.  The package scans tagged
records out of XML files, extracts the members, and offers DataFrame operators
for group sizes, contribution scores and per-member statistics.
"""

__version__ = "0.1.0"
