"""Token ids of whole texts and their cut into pieces.

The ids are those of the ``tokenizers`` library with the given vocabulary file.  Where the
same byte-level vocabulary lies beside it as ranks, plain texts are encoded by ``tiktoken``,
which yields the same ids several times faster; texts that contain a special token's string
always go to ``tokenizers``.  Vocabularies are read from their path on each executor.
"""

from __future__ import annotations

import base64
import os
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

PIECES = "piece int, start bigint, length bigint, ids_crc32 bigint"


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@lru_cache(maxsize=4)
def encoder(path: str):
    """A function from a text to its list of ids."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(path)
    slow = lambda text: exact.encode(text, add_special_tokens=False).ids
    ranked = path.removesuffix(".json") + ".tiktoken"
    if not os.path.exists(ranked):
        return slow
    import public_tokenizers
    import tiktoken

    with open(ranked, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    special = [t.content for t in exact.get_added_tokens_decoder().values()]
    return lambda text: slow(text) if any(s in text for s in special) else fast.encode_ordinary(text)


def cut(length: int, most: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces: only a longer document is cut, its first piece takes the remainder."""
    first = length if length <= most else (length % most or most)
    return [(0, first)] + [(s, most) for s in range(first, length, most)]


def pieces(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", most: int = 1024, end_id: int = 2,
           path: str | None = None, with_ids: bool = False) -> DataFrame:
    """One row per piece of every document: ``doc_id, piece, start, length, ids_crc32`` and, if asked, ``ids``."""
    path = path or vocabulary()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(path)
        for batch in batches:
            rows = []
            for key, value in zip(batch["doc_id"], batch["text"]):
                ids = np.array([*encode(value or ""), end_id], dtype="<u4")
                for k, (start, size) in enumerate(cut(len(ids), most)):
                    part = ids[start:start + size]
                    row = (key, k, start, size, zlib.crc32(part.tobytes()))
                    rows.append((*row, part.astype("int32")) if with_ids else row)
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][:5 + with_ids]
            out = pd.DataFrame(rows, columns=names)
            if not with_ids or rows:
                out["doc_id"] = out["doc_id"].astype("Int64")
            yield out

    schema = f"doc_id bigint, {PIECES}" + (", ids array<int>" if with_ids else "")
    return docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text")).mapInPandas(run, schema)
