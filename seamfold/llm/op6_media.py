"""Media columns: TIFF files in a binary column, one row for each page.

Texts are stored as images losslessly. Their pages take turns at LZW in strips, PackBits
in tiles and deflate in strips with differences; which one begins is drawn from the
payload, so every codec gets about a third of all bytes, short texts' as well as long ones'.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seamfold.llm import tiff
from seamfold.llm.core import prepare

#: Payloads are padded to a positive multiple of this: whole rows of WIDTH samples.
UNIT, WIDTH = 576, 48
#: Bytes of a page, and rows of a strip (8064 bytes).
PAGE, STRIP = 64 * UNIT, 168
WAYS = ({"compression": tiff.LZW, "rows": STRIP}, {"compression": tiff.PACKBITS, "tile": (16, WIDTH)}, {"compression": tiff.DEFLATE, "predictor": 2, "rows": STRIP})


def payload(text: str | None) -> tuple[int, bytes]:
    """Bytes of a text without padding, and the padded bytes."""
    raw = (text or "").encode("utf-8", "replace")
    return len(raw), raw + b"\xff" * (max(UNIT, -(-len(raw) // UNIT) * UNIT) - len(raw))


def store(data: bytes) -> bytes:
    """The TIFF of a payload."""
    first, blocks = zlib.crc32(data), np.frombuffer(data, np.uint8)
    return tiff.write([{"samples": blocks[a : a + PAGE].reshape(-1, WIDTH), **WAYS[(first + a // PAGE) % len(WAYS)]} for a in range(0, len(blocks), PAGE)])


def tiff_pages(media: DataFrame, id_col: str = "doc_id", media_col: str = "media") -> DataFrame:
    """(doc_id, page, width, height, channels, compression, predictor, tiled, samples, error): one row a page.

    A null or empty file gives no rows; a broken one its pages up to the damage and
    then a row with a null page and the error, whatever the damage is. Repeated ids keep their rows, null ids
    too. Other columns are ignored; no rows give none.
    """
    prepare(media.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), *((n, pa.int32()) for n in ("page", "width", "height", "channels", "compression", "predictor")), ("tiled", pa.bool_()), ("samples", pa.binary()), ("error", pa.string())])

    def read(batches):
        for batch in batches:
            for doc, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                for p in _safe(data.as_py() or b""):
                    yield pa.RecordBatch.from_pylist([_row(doc, p)], schema=schema)

    return media.select(F.col(id_col).cast("long").alias("doc_id"), F.col(media_col).alias("media")).mapInArrow(read, "doc_id long, page int, width int, height int, channels int, compression int, predictor int, tiled boolean, samples binary, error string")


def _safe(data: bytes) -> Iterator[tiff.Page | str]:
    if data:
        try:
            yield from tiff.walk(data)
        except tiff.TiffError as e:
            yield str(e)


def _row(doc, p: tiff.Page | str) -> dict:
    if isinstance(p, str):
        return {"doc_id": doc, "error": p}
    return {"doc_id": doc, "page": p.number, "width": p.width, "height": p.height, "channels": p.channels, "compression": p.compression, "predictor": p.predictor, "tiled": p.tiled, "samples": p.samples.tobytes()}


def _contrast(samples: np.ndarray, axis: int) -> int:
    """The sum of absolute differences of neighbours."""
    return int(np.abs(np.diff(samples.astype(np.int16), axis=axis)).sum())


def feature(pages: list[tiff.Page]) -> str:
    """Sizes, mean, deviation, horizontal and vertical contrast and a histogram of the samples of all decoded pages."""
    count = sum(np.bincount(p.samples.reshape(-1), minlength=256) for p in pages)
    n, value = int(count.sum()), np.arange(256.0)
    mean = float(count @ value) / n
    spread = max(0.0, float(count @ value**2) / n - mean**2) ** 0.5
    side, down = (sum(_contrast(p.samples, axis) for p in pages) for axis in (1, 0))
    return f"pages={len(pages)};sizes={','.join(f'{p.width}x{p.height}' for p in pages)};mean={mean:.4f};std={spread:.4f};dx={side};dy={down};hist={','.join(map(str, count.reshape(16, 16).sum(axis=1).tolist()))}"


def text_media(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, media): each text of docs as a TIFF; a null text is an empty one.

    Repeated rows and null ids keep their rows; no rows give none; other columns are ignored.
    """
    prepare(docs.sparkSession)

    def run(batches):
        for batch in batches:
            made = [payload(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([n for n, _ in made], pa.int64()), pa.array([store(d) for _, d in made], pa.binary())], names=["doc_id", "n_bytes", "media"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, n_bytes long, media binary")


def media_digests(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, feature, n_pages) for every row of docs.

    Each text is stored, read back page by page, and what came back is described; null texts are empty ones. Equal
    texts give equal values, repeated rows and null ids keep their rows, no rows give none; other columns are ignored.
    Storing and reading share one pass, so that files do not travel between Python and Spark.
    """
    prepare(docs.sparkSession)
    kinds = {"doc_id": "long", "n_bytes": "long", "payload_bytes": "long", "payload_sha256": "string", "tail_crc32": "long", "media_bytes": "long", "media_sha256": "string", "feature": "string", "n_pages": "int"}

    def run(batches):
        for batch in batches:
            rows: list[tuple] = []
            for text in batch.column(1).to_pylist():
                n, data = payload(text)
                media = store(data)
                pages = list(tiff.walk(media))
                back = b"".join(p.samples.tobytes() for p in pages)
                rows.append((n, len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-32:]), len(media), hashlib.sha256(media).hexdigest(), feature(pages), len(pages)))
            columns = list(zip(*rows, strict=True)) if rows else [()] * 8
            types = {"long": pa.int64(), "string": pa.string(), "int": pa.int32()}
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, types[k]) for c, k in zip(columns, list(kinds.values())[1:], strict=True))], names=list(kinds))

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, ", ".join(f"{k} {v}" for k, v in kinds.items()))
