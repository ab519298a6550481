"""In how many documents each token stands, for sets of hashed tokens packed into arrays.

Tokens go through the shuffle as byte strings, one per group of documents and range of hash
values, which is a small part of what a row per token takes. A token that many documents of one
group share is sent once for that group.
"""

import pickle
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from greenshoe.llm.shared import U64, shuffle_partitions

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# A group ends with so many tokens, so that its arrays take some tens of MB.
GROUP_TOKENS = 1_000_000
RANGES_PER_PARTITION = 4

PACKED = "range long, home long, tokens binary, counts binary, rows binary"
REPLIES = "home long, range long, counts binary, rows binary"


def _group_rows(home: int, rows: dict, tokens: list[np.ndarray], bits: int) -> Iterator[dict]:
    """The rows of one group: its tokens by range, and what its documents need again later."""
    everything = np.concatenate([np.zeros(0, U64), *tokens])
    unique, index, counts = np.unique(everything, return_inverse=True, return_counts=True)
    part = (unique >> U64(64 - bits)).astype(np.int64)
    cuts = np.flatnonzero(np.diff(part)) + 1
    for t, c, p in zip(np.split(unique, cuts), np.split(counts, cuts), np.split(part, cuts)):
        if len(t):
            yield {
                "range": int(p[0]),
                "home": home,
                "tokens": t.tobytes(),
                "counts": np.minimum(c, 65_535).astype(np.uint16).tobytes(),
                "rows": None,
            }
    kept = rows | {
        "sizes": np.array([len(t) for t in tokens], np.int64),
        "index": index.astype(np.uint32),
    }
    yield {
        "range": -1 - home,  # a range of its own
        "home": home,
        "tokens": None,
        "counts": None,
        "rows": pickle.dumps(kept, protocol=5),
    }


def count_tokens(
    docs: DataFrame,
    read: Callable[[pa.RecordBatch], tuple[dict[str, list], list[np.ndarray]]],
    finish: Callable[[dict[str, list], list[np.ndarray], list[np.ndarray]], dict[str, list]],
    schema: StructType,
    needs_tokens: bool,
) -> DataFrame:
    """What ``finish`` makes of documents, their tokens and the tokens' document counts.

    ``read`` turns a batch of ``docs`` into columns to keep and a sorted array of distinct hashes
    per document. ``finish`` gets the kept columns, the tokens (empty unless ``needs_tokens``) and
    the counts per document, and gives columns by ``schema``. A group of documents is addressed by
    the partition and its number in it, so ``docs`` has to give the same rows in the same order
    when a lost partition is computed again, as a scan of files does.
    """
    parts = RANGES_PER_PARTITION * shuffle_partitions(docs.sparkSession)
    bits = max(1, (parts - 1).bit_length())
    arrow_schema = to_arrow_schema(schema)
    packed = pa.schema(
        [("range", pa.int64()), ("home", pa.int64())]
        + [(n, pa.binary()) for n in ("tokens", "counts", "rows")]
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        home = TaskContext.get().partitionId() << 32
        kept, tokens, size = {}, [], 0
        for batch in batches:
            columns, found = read(batch)
            for name, values in columns.items():
                kept.setdefault(name, []).extend(values)
            tokens += found
            size += sum(map(len, found))
            if size >= GROUP_TOKENS:
                yield pa.RecordBatch.from_pylist(
                    list(_group_rows(home, kept, tokens, bits)), packed
                )
                home, kept, tokens, size = home + 1, {}, [], 0
        if tokens:
            yield pa.RecordBatch.from_pylist(list(_group_rows(home, kept, tokens, bits)), packed)

    def count(key, table):
        homes, ranges = table["home"], table["range"]
        if key[0].as_py() < 0:
            return pa.table(
                {"home": homes, "range": ranges, "counts": table["counts"], "rows": table["rows"]}
            )
        tokens = [np.frombuffer(x, U64) for x in table["tokens"].to_pylist()]
        own = [np.frombuffer(x, np.uint16) for x in table["counts"].to_pylist()]
        unique, index = np.unique(np.concatenate(tokens), return_inverse=True)
        total = np.bincount(index, np.concatenate(own), len(unique))
        total = np.minimum(total, 2**32 - 1).astype(np.uint32)[index]
        replies, at = [], 0
        for t in tokens:
            part = total[at : at + len(t)]
            replies.append((part.tobytes() + t.tobytes()) if needs_tokens else part.tobytes())
            at += len(t)
        return pa.table(
            {
                "home": homes,
                "range": ranges,
                "counts": pa.array(replies, pa.binary()),
                "rows": pa.nulls(len(replies), pa.binary()),
            }
        )

    def unpack(key, table):
        rows = sorted(
            zip(*(table[c].to_pylist() for c in ("range", "counts", "rows"))), key=lambda r: r[0]
        )
        kept = pickle.loads(next(r[2] for r in rows if r[2] is not None))
        width = 12 if needs_tokens else 4
        counts, unique = [np.zeros(0, np.uint32)], [np.zeros(0, U64)]
        for _, data, _ in rows:
            if data is not None:
                n = len(data) // width
                counts.append(np.frombuffer(data, np.uint32, n))
                if needs_tokens:
                    unique.append(np.frombuffer(data, U64, n, 4 * n))
        counts, unique = np.concatenate(counts), np.concatenate(unique)
        index, cuts = kept.pop("index"), np.cumsum(kept.pop("sizes"))[:-1]
        by_doc = [counts[i] for i in np.split(index, cuts)]
        tokens = [unique[i] for i in np.split(index, cuts)] if needs_tokens else []
        return pa.table(finish(kept, tokens, by_doc), schema=arrow_schema)

    replies = docs.mapInArrow(pack, PACKED).groupBy("range").applyInArrow(count, REPLIES)
    return replies.groupBy("home").applyInArrow(unpack, schema)
