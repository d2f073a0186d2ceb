"""Training-data operators (URL filters, dedup, tokenising, quality, mixing, PII, WARC).

Functions that run in Python workers are pickled by value, module helpers
included, so executors need only the libraries and not this package.
"""

from pyspark import cloudpickle as _cloudpickle

from inkwell.llm import byte_bpe, induced_sort, quality, simhash, suffix_dedup, warc

for _m in (byte_bpe, induced_sort, quality, simhash, suffix_dedup, warc):
    _cloudpickle.register_pickle_by_value(_m)
