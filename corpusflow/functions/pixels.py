"""Image decoding behind an import: needs Pillow, which isn't part of the required packages."""

from __future__ import annotations

import hashlib
import io
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

try:
    from PIL import Image, ImageOps
except ImportError:  # optional package
    Image = ImageOps = None

#: Prefix of a pixel identity, longest edge of the kept view.
PIXEL_PREFIX = b"RGB8-v1\0"
VIEW_EDGE = 2048
SCHEMA = "source_id string, n_bytes long, format string, frames int, width int, height int, raw_sha256 string, canonical_pixel_sha256 string, error string"


def pixel_hash(width: int, height: int, rgb: bytes) -> str:
    """Identity of 8-bit RGB pixels of a size."""
    return hashlib.sha256(PIXEL_PREFIX + width.to_bytes(8, "big") + height.to_bytes(8, "big") + rgb).hexdigest()


def decode_one(content: bytes, rotation: int) -> tuple:
    """format, frames, width, height, raw hash, pixel hash of upright RGB on white, error."""
    raw = hashlib.sha256(content).hexdigest()
    try:
        with Image.open(io.BytesIO(content)) as img:
            kind, frames = img.format, getattr(img, "n_frames", 1)
            img = ImageOps.exif_transpose(img).rotate(rotation, expand=True) if rotation else ImageOps.exif_transpose(img)
            rgba = img.convert("RGBA")
            flat = Image.alpha_composite(Image.new("RGBA", rgba.size, "white"), rgba).convert("RGB")
            return kind, frames, flat.width, flat.height, raw, pixel_hash(flat.width, flat.height, flat.tobytes()), None
    except Exception as e:  # a broken file is a failure of its row
        return None, None, None, None, raw, None, type(e).__name__


def decode(images: DataFrame) -> DataFrame:
    """What the image gates read, from source_id, content and rotation_degrees."""
    if Image is None:
        raise RuntimeError("decoding images needs Pillow; supply a table of decoded images instead")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(r.source_id, len(r.content), *decode_one(r.content, int(r.rotation_degrees or 0))) for r in pdf.itertuples() if r.content is not None]
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in SCHEMA.split(", ")])

    return images.select("source_id", "content", "rotation_degrees").mapInPandas(run, SCHEMA)
