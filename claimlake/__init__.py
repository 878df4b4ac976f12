"""A library of DataFrame operators that turn text corpora into audited, traceable claims."""
