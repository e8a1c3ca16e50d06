"""vacanta — postings analytics on Spark.

Capture (tagging, ingest rules, seen-key anti-join), bronze envelopes, silver text
rules with keyed de-duplication, a blocking quality gate and a dense-key star
schema, all as Spark plans. See README.md for the layout and the design for scale.
"""

__version__ = "0.1.0"
