"""Corpus operators for training-data pipelines: one module per operator, their registered queries in
``queries``. Nothing outside this subpackage imports it."""
