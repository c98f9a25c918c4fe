"""Frozen encoders as plug-ins, and the visual-feature pipeline.

An image encoder is a picklable callable ``encode(list[bytes]) -> ndarray
(n, d)``; it runs inside ``mapInPandas`` on Arrow batches, is built once per
Python worker (a factory is passed, not the model), and sees each needed
frame exactly once.  The built-in encoder is a byte histogram so the
pipeline runs without a neural network; a real encoder (a CLIP-style model
in ONNX, say) plugs in the same way.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from mise.operators import frames as FR
from mise.session import ship_library

EncoderFactory = Callable[[], Callable[[list], np.ndarray]]


def byte_histogram(dim: int = 64) -> Callable[[list], np.ndarray]:
    """Built-in image encoder: histogram of the file's bytes folded into
    ``dim`` bins.  Deterministic and model-free; for tests and plumbing."""
    def encode(blobs: list) -> np.ndarray:
        out = np.zeros((len(blobs), dim), dtype=np.float64)
        for i, b in enumerate(blobs):
            if b:
                counts = np.bincount(np.frombuffer(bytes(b), dtype=np.uint8), minlength=256).astype(np.float64)
                out[i] = counts.reshape(dim, 256 // dim).sum(axis=1) if 256 % dim == 0 else np.resize(counts, dim)
        return out
    return encode


def number_text(dim: int) -> Callable[[list], np.ndarray]:
    """Encoder for frames stored as comma-separated numbers (e.g. vectors
    exported as text): parses them back.  Exact, model-free."""
    def encode(blobs: list) -> np.ndarray:
        out = np.zeros((len(blobs), dim), dtype=np.float64)
        for i, b in enumerate(blobs):
            if b:
                vals = np.array(bytes(b).decode("ascii").split(","), dtype=np.float32)
                out[i, :min(dim, vals.size)] = vals[:dim]
        return out
    return encode


def _encode_batches(factory: EncoderFactory, content: str, out: str, normalize: bool):
    def run(batches):
        encode = factory()  # once per worker task
        for pdf in batches:
            if len(pdf) == 0:
                continue
            vecs = np.asarray(encode(list(pdf[content])), dtype=np.float64)
            if normalize:
                norms = np.linalg.norm(vecs, axis=1, keepdims=True)
                vecs = np.divide(vecs, norms, out=np.zeros_like(vecs), where=norms > 0)
            res = pdf.drop(columns=[content])
            res[out] = list(vecs.astype(np.float32))
            yield res
    return run


def encode_frames(frames: DataFrame, factory: EncoderFactory = lambda: byte_histogram(64),
                  content: str = "content", out: str = "embedding", normalize: bool = True) -> DataFrame:
    """Encode frame bytes to vectors (L2-normalised by default), dropping the
    bytes.  Input rows should already be the distinct needed frames."""
    ship_library(frames.sparkSession)
    fields = [f for f in frames.schema.fields if f.name != content]
    schema = T.StructType(fields + [T.StructField(out, T.ArrayType(T.FloatType()))])
    return frames.mapInPandas(_encode_batches(factory, content, out, normalize), schema)


def visual_features(clips: DataFrame, archives: DataFrame, dim: int,
                    factory: EncoderFactory = lambda: byte_histogram(64), n: int = 3,
                    normalize: bool = True, dtype: str = "float", streamed: bool = False) -> DataFrame:
    """Clip visual vectors from frame archives, end to end:

    sample ``n`` frames per clip → distinct needed ``(video_id, frame_no)`` →
    header listing of the archives, semi join to the needed set, ranged reads
    (``streamed=True``: one pass over each archive, which may be compressed)
    → encode each needed frame once → join back to the samples → mean pool
    (zeros when nothing was found).  Returns ``(clip_id, found, sampled,
    vec)``.
    """
    from mise.sources.frames import read_frame_archives, stream_archives
    samples = FR.explode_samples(clips, n=n)
    if streamed:
        content = stream_archives(archives, FR.needed_bitmaps(samples))
    else:
        needed = samples.select("video_id", "frame_no").distinct()
        content = read_frame_archives(archives, needed.withColumn("frame_no", needed["frame_no"].cast("int")))
    vectors = encode_frames(content, factory, normalize=normalize)
    vectors = vectors.withColumn("frame_no", vectors["frame_no"].cast("long"))
    return FR.pool_frames(FR.join_frames(samples, vectors, pruned=True), dim, dtype=dtype)
