"""Resumable increments: what is done is left out by an anti-join, or by a file stream's checkpoint."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.functions.udfs import validate_plan


def configuration_hash(configuration: dict) -> str:
    return hashlib.sha256(json.dumps(configuration, sort_keys=True, separators=(",", ":"), ensure_ascii=False).encode()).hexdigest()


def remaining(records: DataFrame, done: DataFrame, key: str = "id") -> DataFrame:
    """Records not done yet; done ids that no record has raise."""
    unknown = done.join(records, key, "left_anti").select(key).limit(5).collect()
    if unknown:
        raise ValueError(f"unknown {key}: {[r[0] for r in unknown]}")
    return records.join(done.select(key).distinct(), key, "left_anti")


def embed_missing(docs: DataFrame, store: str, embed: Callable[[list[str]], list[list[float]]], batch: int = 20) -> int:
    """Append (doc_pos, id, embedding) of the documents that the store at `store` lacks; vectors are made unit length."""
    import numpy as np
    import pandas as pd

    spark = docs.sparkSession
    schema = "doc_pos long, id string, embedding array<float>"
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(store)
    exists = jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(jvm_path)
    todo = docs.join(spark.read.schema(schema).parquet(store).select("doc_pos"), "doc_pos", "left_anti") if exists else docs

    def run(batches):
        for pdf in batches:
            for lo in range(0, len(pdf), batch):
                part = pdf.iloc[lo : lo + batch]
                v = np.array(embed(part["text"].tolist()), np.float64)
                norm = np.linalg.norm(v, axis=1, keepdims=True)
                if len(v) != len(part) or not np.isfinite(v).all() or not norm.all():
                    raise ValueError("embeddings are missing, not finite or zero")
                yield pd.DataFrame({"doc_pos": part["doc_pos"].values, "id": part["id"].values, "embedding": list((v / norm).astype(np.float32))})

    before = spark.read.schema(schema).parquet(store).count() if exists else 0
    todo.select("doc_pos", "id", "text").mapInPandas(run, schema).write.mode("append").parquet(store)
    return spark.read.schema(schema).parquet(store).count() - before


def hashed_embedding(texts: list[str], dimensions: int = 64) -> list[list[float]]:
    """A stand-in for an embedding model: equal texts, equal vectors; nothing more is meant by them."""
    out = []
    for t in texts:
        raw = b"".join(hashlib.sha256(f"{k}:{t}".encode()).digest() for k in range(-(-dimensions // 16)))
        out.append([(raw[2 * i] * 256 + raw[2 * i + 1]) / 32767.5 - 1 for i in range(dimensions)])
    return out


def ingest_plans(spark: SparkSession, source: str, sink: str, checkpoint: str) -> None:
    """A stream of JSON files (id, plan): each run takes the new files, validates and appends, and stops."""
    stream = spark.readStream.schema("id string, plan string").json(source)
    checked = stream.withColumn("errors", validate_plan("plan")).withColumn("status", F.when(F.size("errors") == 0, "success").otherwise("invalid"))
    query = checked.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
