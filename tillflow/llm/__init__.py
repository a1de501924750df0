"""Training-data operators: classifiers, sharding, near-duplicates, rules,
search, language-model scores, mixing, tokenisation and archives.

Nothing outside this subpackage imports it.  ``queries.py`` registers one
``opN_<name>`` query per operator; the modules hold the operators themselves.
"""
