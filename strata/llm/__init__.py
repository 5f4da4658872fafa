"""Training-data operators: sharding, decontamination, quality voting, token
files, WARC revisits, URL rules, near-duplicates, personal data, source
mixing and repeated passages.

Each module holds one operator with its own interface; ``queries`` registers
one query per operator.  Nothing outside this subpackage imports it.
"""
