"""Tables in the shared folder that cut lineage and survive lost executors."""

from __future__ import annotations

from pyspark.sql import DataFrame

from clientpulse.session import scratch_path


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to a fresh table in the shared folder and read it back.

    A lost executor costs the tasks it ran and no more. The table stays for as long as the returned frame may be
    read; ``drop`` removes it early, and the rest goes with the folder when the application's scratch is cleared.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop(df: DataFrame) -> None:
    """Delete the files of a frame made by ``stored`` that nothing will read again."""
    session = df.sparkSession
    folders = {name.rpartition("/")[0] for name in df.inputFiles()}
    for folder in folders:
        path = session._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(session._jsc.hadoopConfiguration()).delete(path, True)
