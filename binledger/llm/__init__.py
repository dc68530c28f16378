"""Operators of a training-data pipeline over tables of documents. Nothing else
in the package imports this one."""

from pyspark import cloudpickle

from binledger.llm import alignment, bpe, language, lines, near, pieces, ppm, shards, staging, stripes, tiling, token_files

# As in the package above: functions of tasks travel by value.
for _module in (alignment, bpe, language, lines, near, pieces, ppm, shards, staging, stripes, tiling, token_files):
    cloudpickle.register_pickle_by_value(_module)
