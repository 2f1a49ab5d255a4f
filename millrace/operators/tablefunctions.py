"""Table functions over Arrow batches, callable from SQL.

``json_members(TABLE(...))`` takes a table of ``id`` and a JSON ``text``.  Arrow table functions
are not allowed in lateral joins: the table argument carries what the result is joined by.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

# What runs in tasks travels with the job: executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class JsonMembers:
    """``id, name, number`` for each member of each text's object, whole numbers only.

    Texts that are null, no JSON or no object have no members; a member of another kind has
    a null number.
    """

    def eval(self, batch: pa.RecordBatch) -> Iterator[pa.Table]:
        texts = batch.column("text")
        unlike = texts.dictionary_encode()  # equal texts are parsed once
        parsed = [self._members(text) for text in unlike.dictionary.to_pylist()]
        codes = unlike.indices.to_numpy(zero_copy_only=False)
        some = np.flatnonzero(~np.isnan(codes.astype(float)))
        codes = codes[some].astype(int)
        counts = np.array([len(members) for members in parsed], dtype=int)
        rows = np.repeat(some, counts[codes]) if len(parsed) else np.zeros(0, int)
        members = [member for code in codes for member in parsed[code]]
        yield pa.table(
            {
                "id": batch.column("id").take(pa.array(rows, pa.int64())),
                "name": pa.array([name for name, _ in members], pa.string()),
                "number": pa.array([number for _, number in members], pa.int64()),
            }
        )

    @staticmethod
    def _members(text: str) -> list[tuple]:
        try:
            found = json.loads(text)
        except ValueError:
            return []
        if not isinstance(found, dict):
            return []
        return [
            (name, value if isinstance(value, int) and not isinstance(value, bool) and -(2**63) <= value < 2**63 else None)
            for name, value in found.items()
        ]


def register_table_functions(spark: SparkSession) -> None:
    """Makes the table functions of this module known to the session's SQL."""
    function = F.arrow_udtf(JsonMembers, returnType="id long, name string, number long")
    spark.udtf.register("json_members", function)
