"""Texts packed with Zstandard for a shuffle that carries them many times."""

from __future__ import annotations

from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

LEVEL, WIDTH = 1, 4
# Texts that pack to less than this share stay as they are: batches are bounded by packed bytes.
LEAST = 1 / 16
PLAIN = (1 << 8 * WIDTH) - 1


def packed(text: Column) -> Column:
    """The text as its length in bytes and a Zstandard frame; null stays null."""

    @F.arrow_udf("binary")
    def pack(texts: pa.Array) -> pa.Array:
        codec = pa.Codec("zstd", LEVEL)

        def one(raw: pa.Buffer) -> bytes:
            frame = codec.compress(raw, asbytes=True)
            if len(frame) < LEAST * raw.size:
                return PLAIN.to_bytes(WIDTH, "little") + raw.to_pybytes()
            return raw.size.to_bytes(WIDTH, "little") + frame

        raws = (value.as_buffer() for value in texts.cast(pa.binary()))
        return pa.array([None if raw is None else one(raw) for raw in raws], pa.binary())

    return pack(text)


def unpacked(data: Column) -> Column:
    """The text of ``packed``."""

    @F.arrow_udf("string")
    def unpack(frames: pa.Array) -> pa.Array:
        codec = pa.Codec("zstd")

        def one(raw: pa.Buffer | None) -> bytes | pa.Buffer:
            if raw is None:
                return b""
            size, rest = int.from_bytes(raw.slice(0, WIDTH), "little"), raw.slice(WIDTH)
            return rest if size == PLAIN else codec.decompress(rest, size, asbytes=True)

        # the array is laid over the joined texts, which are many times their frames
        texts = [one(value.as_buffer()) for value in frames.cast(pa.binary())]
        offsets = pa.array(accumulate(map(len, texts), initial=0), pa.int32())
        there = pa.array(frames.is_valid().to_pylist(), pa.bool_())
        return pa.StringArray.from_buffers(
            len(texts), offsets.buffers()[1], pa.py_buffer(b"".join(texts)), there.buffers()[1]
        )

    return unpack(data)
