"""Column functions on vectors held as arrays."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def as_doubles(v: Column) -> Column:
    return v.cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(as_doubles(a), as_doubles(b), lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)


def l2_norm(v: Column) -> Column:
    return F.sqrt(F.aggregate(as_doubles(v), F.lit(0.0), lambda acc, x: acc + x * x))


def l1_distance(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(as_doubles(a), as_doubles(b), lambda x, y: F.abs(x - y)), F.lit(0.0), lambda acc, x: acc + x)


def normalized(v: Column) -> Column:
    """Scaled to length one; zero vectors stay zero."""
    length = F.greatest(l2_norm(v), F.lit(1e-12))
    return F.transform(as_doubles(v), lambda x: x / length)


def cosine(a: Column, b: Column) -> Column:
    """1 - cosine distance; null with a null or zero vector."""
    return F.try_divide(dot(a, b), l2_norm(a) * l2_norm(b))


def hash_embedding(dimension: int = 1024):
    """A stand-in for a model: texts -> unit vectors drawn from a seed that is the text's own hash, so that any worker
    gives the same. One Arrow batch at a time."""

    @F.pandas_udf("array<float>")
    def embed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import hashlib

        for texts in batches:
            out = []
            for text in texts:
                seed = int.from_bytes(hashlib.sha256((text or "").encode()).digest()[:4], "little")
                v = np.random.RandomState(seed).randn(dimension)
                out.append((v / max(np.linalg.norm(v), 1e-12)).astype(np.float32))
            yield pd.Series(out)

    return embed


def model_embedding(load: Callable[[], Callable[[list[str]], np.ndarray]], batch_size: int = 32):
    """texts -> unit vectors by a model. `load` gives a function from texts to a matrix; a Python worker calls it once,
    on the first batch that it sees."""

    @F.pandas_udf("array<float>")
    def embed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = None
        for texts in batches:
            model = model or load()
            filled = texts.fillna("").tolist()
            rows = [model(filled[at : at + batch_size]) for at in range(0, len(filled), batch_size)]
            matrix = np.vstack(rows) if rows else np.empty((0, 1))
            lengths = np.maximum(np.linalg.norm(matrix, axis=1, keepdims=True), 1e-12)
            yield pd.Series(list((matrix / lengths).astype(np.float32)))

    return embed


def onnx_model(folder: str) -> Callable[[list[str]], np.ndarray]:
    """A sentence model from a folder with model.onnx and tokenizer.json: the first token's vector."""
    import onnxruntime
    from tokenizers import Tokenizer

    session = onnxruntime.InferenceSession(f"{folder}/model.onnx")
    tokenizer = Tokenizer.from_file(f"{folder}/tokenizer.json")
    tokenizer.enable_padding()
    tokenizer.enable_truncation(8192)
    wanted = {i.name for i in session.get_inputs()}

    def embed(texts: list[str]) -> np.ndarray:
        found = tokenizer.encode_batch(texts)
        given = {"input_ids": [e.ids for e in found], "attention_mask": [e.attention_mask for e in found], "token_type_ids": [e.type_ids for e in found]}
        out = session.run(None, {k: np.array(v, np.int64) for k, v in given.items() if k in wanted})[0]
        return out[:, 0] if out.ndim == 3 else out

    return embed


QUERY_PREFIX = "Represent this sentence for searching relevant passages: "


def query_text(q: Column, prefix: str = QUERY_PREFIX) -> Column:
    return F.concat(F.lit(prefix), q)
