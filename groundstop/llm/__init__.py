"""Training-data operators: filtering, deduplication, packing, scoring and output of text corpora.

Nothing else in the library imports this package.  Each module holds one
operator with its own general interface; ``queries`` registers the thin
``opN_*`` queries that run them over whole tables.

Common rules
------------
* A document is a row.  Rows may repeat ids or texts, ids and texts may be
  null; every module states what it returns then.
* Only the named columns of an input are read, so further columns, also with
  clashing names, do no harm.
* Intermediate tables go below the session's checkpoint folder.
"""
