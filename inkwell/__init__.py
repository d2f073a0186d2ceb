"""inkwell: news-feed ingest and article analytics as Spark DataFrame jobs.

Feeds and fetched pages arrive as tables; everything from entry parsing to the
upserted article snapshot is expressed with DataFrame / SQL operators so that
Catalyst, AQE and Tungsten plan the physical work.
"""

from pyspark import cloudpickle as _cloudpickle

import inkwell.functions.text as _text
import inkwell.streaming.ttl as _ttl
from inkwell.session import get_session, scratch_dir

# Functions that run in Python workers (the Arrow UDF and the keyed-state
# function) are shipped by value, so executors need not have this package
# installed or on their path.
for _m in (_text, _ttl):
    _cloudpickle.register_pickle_by_value(_m)

__all__ = ["get_session", "scratch_dir"]
