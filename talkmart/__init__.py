"""Social-listening analytics as plain DataFrame transformations.

Public functions take and return DataFrames or Columns; only the jobs in
``talkmart.plans`` and the readers and writers in ``talkmart.sources`` do I/O.
"""
