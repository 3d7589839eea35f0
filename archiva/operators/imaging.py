"""Page images: numpy kernels run over Arrow batches, and their figures."""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Named bands of brightness and the quantiles that are reported.
BINS = [("negro_0_31", 0, 31), ("oscuro_32_63", 32, 63), ("gris_64_127", 64, 127), ("gris_claro_128_191", 128, 191), ("casi_blanco_192_223", 192, 223), ("muy_claro_224_239", 224, 239), ("blanco_sucio_240_247", 240, 247), ("blanco_248_255", 248, 255)]
QUANTILES = [1, 5, 10, 25, 50, 75, 90, 95, 99]
# The settings every profile starts from.
BASE = {"bg_ksize": 31, "bin_method": "sauvola", "sauvola_w": 31, "sauvola_k": 0.34, "close_ksize": 2, "open_ksize": 0, "denoise_ksize": 3, "zoom": 1.15}


def gray(img: np.ndarray) -> np.ndarray:
    """Brightness of a BGR image; grey images stay."""
    if img.ndim == 2:
        return img
    b, g, r = (img[..., i].astype(np.float64) for i in range(3))
    return np.clip(np.rint(0.114 * b + 0.587 * g + 0.299 * r), 0, 255).astype(np.uint8)


def _windows(img: np.ndarray, k: int, mode: str = "edge") -> np.ndarray:
    h = k // 2
    return np.lib.stride_tricks.sliding_window_view(np.pad(img, ((h, k - 1 - h), (h, k - 1 - h)), mode=mode), (k, k))


def median(img: np.ndarray, k: int) -> np.ndarray:
    """Median of a k by k window, edges repeated; even k count one more, k up to 1 does nothing."""
    k = int(k)
    if k <= 1:
        return img
    k += k % 2 == 0
    out = np.empty_like(img)
    for y in range(0, img.shape[0], 64):  # bands, as the windows are copied
        part = _windows(img[max(0, y - k // 2) : y + 64 + k // 2], k)
        top = y - max(0, y - k // 2)
        rows = min(64, img.shape[0] - y)
        out[y : y + rows] = np.median(part[top : top + rows].reshape(rows, img.shape[1], -1), axis=-1)
    return out


def flatten_background(img: np.ndarray, k: int) -> np.ndarray:
    """Brightness over that of the background, which is the median around; nothing over nothing is 0."""
    if k <= 0:
        return img
    bg = median(img, k).astype(np.float64)
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(bg > 0, np.clip(np.rint(img * 255.0 / bg), 0, 255), 0).astype(np.uint8)


def box_mean(img: np.ndarray, k: int) -> np.ndarray:
    """Mean of a k by k window with mirrored edges, by an integral image."""
    h = k // 2
    p = np.pad(img.astype(np.float64), h, mode="reflect" if min(img.shape) > h else "edge")
    s = np.pad(p.cumsum(0).cumsum(1), ((1, 0), (1, 0)))
    return (s[k:, k:] - s[:-k, k:] - s[k:, :-k] + s[:-k, :-k]) / (k * k)


def sauvola(img: np.ndarray, k: int = 31, weight: float = 0.34) -> np.ndarray:
    """Local threshold by mean and spread; the mean is rounded to whole grey levels."""
    k += k % 2 == 0
    mean = np.rint(box_mean(img, k)).astype(np.float64)
    spread = np.sqrt(np.maximum(box_mean(img.astype(np.float64) ** 2, k) - mean**2, 0))
    return np.where(img > mean * (1 + weight * (spread / 128 - 1)), 255, 0).astype(np.uint8)


def otsu(img: np.ndarray) -> np.ndarray:
    """Global threshold with the greatest variance between both sides."""
    hist = np.bincount(img.ravel(), minlength=256).astype(np.float64)
    w = np.cumsum(hist)
    m = np.cumsum(hist * np.arange(256))
    with np.errstate(divide="ignore", invalid="ignore"):
        var = np.nan_to_num((m[-1] * w / w[-1] - m) ** 2 / (w * (w[-1] - w)))
    return np.where(img > int(var.argmax()), 255, 0).astype(np.uint8)


def adaptive(img: np.ndarray, k: int = 35, c: float = 11) -> np.ndarray:
    """Threshold by the Gaussian mean around, less a constant."""
    k += k % 2 == 0
    sigma = 0.3 * ((k - 1) * 0.5 - 1) + 0.8
    g = np.exp(-((np.arange(k) - k // 2) ** 2) / (2 * sigma**2))
    g /= g.sum()
    p = np.pad(img.astype(np.float64), k // 2, mode="edge")
    rows = np.apply_along_axis(np.convolve, 1, p, g, "valid")
    mean = np.apply_along_axis(np.convolve, 0, rows, g, "valid")
    return np.where(img > np.rint(mean) - c, 255, 0).astype(np.uint8)


def binarize(img: np.ndarray, method: str = "auto", **p: float) -> np.ndarray:
    """sauvola, otsu, adaptive, or auto: of the latter two the one with the greater spread, otsu in a tie."""
    if method == "sauvola":
        return sauvola(img, int(p.get("sauvola_w", 31)), p.get("sauvola_k", 0.34))
    if method == "otsu":
        return otsu(img)
    local = adaptive(img, int(p.get("block_size", 35)), p.get("c", 11))
    if method == "adaptive":
        return local
    both = otsu(img)
    return local if local.std() > both.std() else both


def mend_strokes(img: np.ndarray, close: int | None = 2, open_: int | None = 0) -> np.ndarray:
    """Gaps in strokes closed, then specks taken away, on black text."""
    out = 255 - img
    for k, first, then, pad in ((close, np.max, np.min, 0), (open_, np.min, np.max, 255)):
        if k:
            a = first(np.lib.stride_tricks.sliding_window_view(np.pad(out, ((k // 2, k - 1 - k // 2),) * 2, constant_values=pad), (k, k)), axis=(2, 3))
            out = then(np.lib.stride_tricks.sliding_window_view(np.pad(a, ((k - 1 - k // 2, k // 2),) * 2, constant_values=255 - pad), (k, k)), axis=(2, 3))
    return 255 - out


def zoom(img: np.ndarray, factor: float) -> np.ndarray:
    """Resized by linear interpolation between pixel centres."""
    if factor == 1.0 or factor <= 0:
        return img
    h, w = max(1, int(img.shape[0] * factor)), max(1, int(img.shape[1] * factor))
    y = np.clip((np.arange(h) + 0.5) / factor - 0.5, 0, img.shape[0] - 1)
    x = np.clip((np.arange(w) + 0.5) / factor - 0.5, 0, img.shape[1] - 1)
    y0, x0 = np.floor(y).astype(int), np.floor(x).astype(int)
    y1, x1 = np.minimum(y0 + 1, img.shape[0] - 1), np.minimum(x0 + 1, img.shape[1] - 1)
    fy, fx = (y - y0)[:, None], (x - x0)[None, :]
    a = img.astype(np.float64)
    out = a[y0][:, x0] * (1 - fy) * (1 - fx) + a[y0][:, x1] * (1 - fy) * fx + a[y1][:, x0] * fy * (1 - fx) + a[y1][:, x1] * fy * fx
    return np.clip(np.rint(out), 0, 255).astype(np.uint8)


def prepare(img: np.ndarray, params: Mapping[str, object] | None = None, dpi: int = 300, target_dpi: int = 300) -> np.ndarray:
    """The whole preparation of a page: grey, resized, even background, black and white, mended, cleaned."""
    p = {**BASE, **(params or {})}
    g = gray(img)
    if dpi > 0 and dpi != target_dpi:
        g = zoom(g, target_dpi / dpi)
    g = flatten_background(zoom(g, float(p["zoom"])), int(p["bg_ksize"]))
    b = binarize(g, str(p["bin_method"]), sauvola_w=int(p["sauvola_w"]), sauvola_k=float(p["sauvola_k"]))
    return median(mend_strokes(b, int(p["close_ksize"]), int(p["open_ksize"])), int(p["denoise_ksize"]))


def trim(img: np.ndarray, margin: int = 3, pad: int = 8) -> np.ndarray:
    """The box around all ink with a margin, on a white border."""
    ys, xs = np.where(img < 255)
    if len(ys):
        img = img[max(0, ys.min() - margin) : ys.max() + 1 + margin, max(0, xs.min() - margin) : xs.max() + 1 + margin]
    return np.pad(img, pad, constant_values=255)


def crop(img: np.ndarray, x1: int, y1: int, x2: int, y2: int, pad: int = 0) -> np.ndarray:
    """A part of an image, with a white border if wanted."""
    out = img[max(0, y1) : max(0, y2), max(0, x1) : max(0, x2)]
    return np.pad(out, ((pad, pad), (pad, pad)) + ((0, 0),) * (out.ndim - 2), constant_values=255) if pad else out


def row_profile(img: np.ndarray, dark: int = 128) -> np.ndarray:
    """Ink in each row."""
    return (img < dark).sum(axis=1)


def small_components(img: np.ndarray, most: int = 20, dark: int = 128) -> int:
    """Specks of ink, joined over eight neighbours, of at most so many pixels."""
    ink = img < dark
    label = np.where(ink, np.arange(ink.size).reshape(ink.shape), ink.size)
    while True:
        p = np.pad(label, 1, constant_values=ink.size)
        low = np.lib.stride_tricks.sliding_window_view(p, (3, 3)).min(axis=(2, 3))
        new = np.where(ink, low, ink.size)
        flat = np.append(new.ravel(), ink.size)
        new = np.where(ink, flat[new], ink.size)
        if (new == label).all():
            break
        label = new
    sizes = np.bincount(label[ink].ravel())
    return int(((sizes > 0) & (sizes <= most)).sum())


def figures(pixels: np.ndarray) -> dict[str, float]:
    """Brightness figures of an image, all from one histogram of 256 levels; zeros for empty images."""
    hist = np.bincount(np.asarray(pixels, np.uint8).ravel(), minlength=256).astype(np.float64)
    n = hist.sum()
    out: dict[str, float] = {"pixel_count": n}
    if not n:
        return out | dict.fromkeys(["mean", "std", "min", "max", "dark_lt_64", "ink_lt_128", "white_ge_240", "paper_ge_248", *(f"p{q:02d}" for q in QUANTILES), *(b[0] for b in BINS)], 0.0)
    levels = np.arange(256)
    mean = (hist * levels).sum() / n
    share = lambda a, b: float(hist[a : b + 1].sum() / n)
    there = np.flatnonzero(hist)
    out |= {"mean": mean, "std": float(np.sqrt((hist * (levels - mean) ** 2).sum() / n)), "min": float(there[0]), "max": float(there[-1])}
    out |= {"dark_lt_64": share(0, 63), "ink_lt_128": share(0, 127), "white_ge_240": share(240, 255), "paper_ge_248": share(248, 255)}
    cum = np.cumsum(hist)
    for q in QUANTILES:
        at = (n - 1) * q / 100
        lo, hi = (int(np.searchsorted(cum, k, side="right")) for k in (np.floor(at), np.ceil(at)))
        out[f"p{q:02d}"] = lo + (hi - lo) * (at - np.floor(at))
    return out | {name: share(a, b) for name, a, b in BINS}


FIGURES = list(figures(np.zeros(0, np.uint8)))


def pixel_figures(df: DataFrame, key: str, pixels: str) -> DataFrame:
    """``key`` and FIGURES of each array (or binary) of grey levels; null images are empty."""
    picked = df.select(F.col(key).alias("_k"), F.col(pixels).alias("_p"))
    kt = picked.schema["_k"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [figures(np.frombuffer(p, np.uint8) if isinstance(p, bytes) else np.asarray(p or [], np.int64)) for p in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array([float(r[c]) for r in rows], pa.float64()) for c in FIGURES)], names=[key, *FIGURES])

    return picked.mapInArrow(run, f"`{key}` {kt}, " + ", ".join(f"{c} double" for c in FIGURES))


def map_images(df: DataFrame, kernel, params: Mapping[str, object] | None = None) -> DataFrame:
    """``df`` (key columns, height, width, nChannels, data) with data, height and width after a numpy kernel."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = b.to_pylist()
            for r in rows:
                if r["data"] is None:
                    continue
                shape = (r["height"], r["width"]) + ((r["nChannels"],) if r["nChannels"] > 1 else ())
                out = kernel(np.frombuffer(r["data"], np.uint8).reshape(shape), params) if params is not None else kernel(np.frombuffer(r["data"], np.uint8).reshape(shape))
                r |= {"data": np.ascontiguousarray(out).tobytes(), "height": out.shape[0], "width": out.shape[1], "nChannels": 1 if out.ndim == 2 else out.shape[2]}
            yield pa.RecordBatch.from_pylist(rows, schema=b.schema).select(names)

    return df.mapInArrow(run, schema)
