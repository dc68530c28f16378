"""Incremental metadata of executable files, on Spark."""

from pyspark import cloudpickle

from binledger.functions import globs, symbols
from binledger.operators import catalog, checks, extract, headers, ledger, sample
from binledger.sources import files, tables

# Functions that run in Python workers travel with the tasks, so executors need
# no copy of this package.
for _module in (globs, symbols, extract, files):
    cloudpickle.register_pickle_by_value(_module)
