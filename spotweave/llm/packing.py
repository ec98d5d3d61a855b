"""Filling containers of fixed capacity with texts, as full as possible and with balanced cost.

Cost-balanced packing: a text's cost is estimated as linear plus quadratic attention cost in its tokens; texts
are taken in descending length and each goes to the container of lowest cost that still has room for it.

Texts are first spread by a hash of their place over groups of a bounded number of tokens, and each group is packed by itself:
a group of about a thousand containers leaves no more room unused than the whole corpus would, and no task
holds more than one group. A text over the capacity is cut at multiples of the capacity; no other is split.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..staging import stage

CAPACITY = 2048
#: Tokens of a group: about a thousand containers.
GROUP_TOKENS = CAPACITY * 1024
#: The length in tokens at which the attention cost of a text equals its linear cost.
EVEN_LENGTH = 4096.0
_SCHEMA = "container_id bigint, doc_id bigint, piece int, start_token bigint, n_tokens bigint, slot int"
_GROUP_BITS = 24


def cost(n: np.ndarray, even: float = EVEN_LENGTH) -> np.ndarray:
    """Linear plus quadratic cost of texts of ``n`` tokens."""
    return n + n * n / even


def assign(sizes: np.ndarray, capacity: int = CAPACITY, even: float = EVEN_LENGTH) -> np.ndarray:
    """The container of each size (descending): the one of lowest cost with room for it, else a new one.

    Starts with as many containers as the sizes fill at least. Containers that are too full wait aside by their
    room and come back when the sizes have fallen far enough.
    """
    n = max(1, math.ceil(int(sizes.sum()) / capacity))
    room = [capacity] * n
    open_ = [(0.0, j) for j in range(n)]
    aside: list[tuple[int, float, int]] = []
    costs, out = cost(sizes.astype(float), even).tolist(), []
    for size, c in zip(sizes.tolist(), costs):
        while aside and -aside[0][0] >= size:
            r, total, j = heapq.heappop(aside)
            heapq.heappush(open_, (total, j))
        while open_ and room[open_[0][1]] < size:
            total, j = heapq.heappop(open_)
            heapq.heappush(aside, (-room[j], total, j))
        if open_:
            total, j = heapq.heappop(open_)
        else:
            total, j = 0.0, len(room)
            room.append(capacity)
        room[j] -= size
        heapq.heappush(open_, (total + c, j))
        out.append(j)
    return np.array(out, np.int64)


def pack(lengths: DataFrame, capacity: int = CAPACITY, group_tokens: int = GROUP_TOKENS, even: float = EVEN_LENGTH) -> DataFrame:
    """``container_id, slot, doc_id, piece, start_token, n_tokens`` of ``doc_id, n_tokens``: every token once.

    A text within the capacity is one piece 0; a longer one has pieces of the full capacity and a last one with
    the rest. Texts without tokens (null and empty ones) take no place and have no row; rows sent twice are
    packed twice, and null or repeated ids spread like others. Equal lengths go in the order of ``doc_id``. An empty table gives an empty one.
    """
    m = F.col("_metadata")
    place = F.xxhash64(F.substring(m["file_name"], 1, 10), m["row_index"])  # the number of its file, and its row there
    known = stage(lengths.select("doc_id", "n_tokens"), "pack-lengths").select("*", place.alias("place")).where("n_tokens > 0")
    total = known.agg(F.sum(F.col("n_tokens") + 1)).first()[0] or 0
    groups = max(1, math.ceil(total / group_tokens))
    cut = F.explode(F.sequence(F.lit(0), F.floor((F.col("n_tokens") - 1) / capacity))).alias("piece")
    pieces = known.select("doc_id", "n_tokens", "place", cut).select(
        "doc_id",
        "place",
        F.col("piece").cast("int").alias("piece"),
        (F.col("piece") * capacity).cast("long").alias("start_token"),
        F.least(F.col("n_tokens") - F.col("piece") * capacity, F.lit(capacity)).cast("long").alias("n_tokens"),
    )
    grouped = pieces.withColumn("grp", F.pmod(F.xxhash64("place", "piece"), F.lit(groups))).drop("place")

    def each(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["n_tokens", "doc_id", "piece"], ascending=[False, True, True], kind="stable")
        where = assign(rows.n_tokens.to_numpy(), capacity, even)
        rows["container_id"] = (key[0] << _GROUP_BITS) + where
        rows["slot"] = rows.groupby("container_id").cumcount().astype("int32")
        return rows[["container_id", "doc_id", "piece", "start_token", "n_tokens", "slot"]]

    return grouped.groupBy("grp").applyInPandas(each, _SCHEMA)


def split_texts(packed: DataFrame) -> DataFrame:
    """``doc_id`` of the texts that had to be split: those over the capacity."""
    return packed.where("piece = 1").select("doc_id").distinct()


def containers(packed: DataFrame, capacity: int = CAPACITY, even: float = EVEN_LENGTH) -> DataFrame:
    """Per container its pieces, tokens, unused space and cost."""
    n = F.col("n_tokens")
    return packed.groupBy("container_id").agg(
        F.count(F.lit(1)).alias("n_pieces"),
        F.sum(n).alias("n_tokens"),
        (F.lit(capacity) - F.sum(n)).alias("n_unused"),
        F.sum(n + n * n / F.lit(even)).alias("cost"),
    )
