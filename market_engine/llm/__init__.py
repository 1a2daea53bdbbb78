"""Training-data operators over the tables documents, pages, benchmark, labels and conversations.

One module per operator, each with a general DataFrame interface; ``queries`` holds the thin
registered queries and ``sql`` their DuckDB counterparts. Nothing else in the library imports this
subpackage.
"""
