"""Integer geometry of images."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fit_pad(w: Column, h: Column, side: int) -> dict[str, Column]:
    """Size after scaling the longer side to ``side``, and the padding; sizes are cut off, odd rests go right and down."""
    scale = F.lit(float(side)) / F.greatest(w, h)
    nw, nh = (w * scale).cast("int"), (h * scale).cast("int")
    left, top = F.floor((side - nw) / 2).cast("int"), F.floor((side - nh) / 2).cast("int")
    return {"new_w": nw, "new_h": nh, "pad_left": left, "pad_top": top, "pad_right": side - nw - left, "pad_bottom": side - nh - top}


def align(n: Column, m: Column, unit: int = 8) -> tuple[Column, Column]:
    """Both sides down to multiples; if either would vanish, both stay, at one unit at least."""
    down = lambda x: (F.floor(x / unit) * unit).cast("int")
    gone = (down(n) == 0) | (down(m) == 0)
    keep = lambda x: F.when(gone, F.greatest(F.lit(unit), x.cast("int"))).otherwise(down(x))
    return keep(n), keep(m)


def latent_shape(w: Column, h: Column, channels: int = 4, unit: int = 8) -> Column:
    return F.array(F.lit(channels), F.floor(h / unit).cast("int"), F.floor(w / unit).cast("int"))
