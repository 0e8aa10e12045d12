"""One strict JSON document per text: the entry of all sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

_OPTIONS = {"columnNameOfCorruptRecord": "_bad", "allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}


def with_document(df: DataFrame, body: str, kind: str, name: str) -> DataFrame:
    """Add ``name``: the text of ``body`` as a value of type ``kind``, NULL unless it is one whole document.

    NULL and blank texts, ``null``, broken JSON, wrong types, several documents and text
    after the document all give NULL. The text is read inside a wrapper that ends in its
    own hash, so a text cannot close the wrapper early and put members beside itself.
    """
    mark = F.hex(F.xxhash64(body))
    wrapped = F.concat(F.lit('{"doc":['), F.col(body), F.lit('],"end":"'), mark, F.lit('"}'))
    read = F.from_json(F.col("_wrapped"), f"doc array<{kind}>, end string, _bad string", _OPTIONS)
    whole = _whole(F.col("_read"), F.col("_wrapped"), mark)
    return (df.withColumn("_wrapped", wrapped).withColumn("_read", read)
            .withColumn(name, F.when(whole, F.get(F.col("_read.doc"), F.lit(0)))).drop("_wrapped", "_read"))


def _whole(read: Column, wrapped: Column, mark: Column) -> Column:
    keys = F.array(F.lit("doc"), F.lit("end"))
    return (read["_bad"].isNull() & (F.size(read["doc"]) == 1) & (read["end"] == mark)
            & (F.json_object_keys(wrapped) == keys))
