"""Where the vocabulary files of public tokenizers are."""

from __future__ import annotations

from pyspark.sql import SparkSession


def vocabulary(spark: SparkSession, name: str) -> str:
    """The file's path: in the folder that the session names in ``riskframe.tokenizers``, else the installed one.

    The path must be readable on every executor; the files are installed with the Python packages there.
    """
    folder = spark.conf.get("riskframe.tokenizers", None)
    if folder:
        return f"{folder.rstrip('/')}/{name}"
    import public_tokenizers

    return public_tokenizers.path(name)
