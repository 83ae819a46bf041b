"""Seeded degradation of page images: grey rasters as binary columns, transformed in Arrow batches.

A raster is one byte a pixel, row by row, with its width. Steps run in the order in which a page is damaged: ink shows
through from the back, the page lies askew, is captured coarsely, with sensor noise and specks, thresholded as by a fax, and stored lossily.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

BLOCK = 8  # pixels of a side of the blocks that lossy storage quantizes


@dataclass(frozen=True)
class Damage:
    bleed: float = 0.0
    degrees: float = 0.0
    scale: float | None = None
    sigma: float = 0.0
    specks: float = 0.0
    fax: bool = False
    stored: int | None = None


#: The four presets.
LEVELS = {
    "light": Damage(degrees=0.4, scale=0.7, sigma=6.0, stored=55),
    "medium": Damage(bleed=0.10, degrees=1.0, scale=0.45, sigma=14.0, specks=0.01, stored=32),
    "fax": Damage(bleed=0.16, degrees=1.6, scale=0.32, sigma=22.0, specks=0.03, fax=True, stored=22),
    "shred": Damage(bleed=0.22, degrees=2.6, scale=0.16, sigma=40.0, specks=0.08, stored=10),
}


def show_through(page: np.ndarray, strength: float) -> np.ndarray:
    back = 255 - (255 - page[:, ::-1].astype(float)) * strength
    return np.minimum(page, back.astype(np.uint8))


def sampled(page: np.ndarray, y: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The page at fractional places, mixed from the four pixels around; white outside."""
    h, w = page.shape
    padded = np.pad(page.astype(float), 1, constant_values=255)
    y, x = np.clip(y, -1, h) + 1, np.clip(x, -1, w) + 1
    y0, x0 = np.minimum(y.astype(int), h), np.minimum(x.astype(int), w)
    fy, fx = y - y0, x - x0
    top = padded[y0, x0] * (1 - fx) + padded[y0, x0 + 1] * fx
    low = padded[y0 + 1, x0] * (1 - fx) + padded[y0 + 1, x0 + 1] * fx
    return np.rint(top * (1 - fy) + low * fy).astype(np.uint8)


def askew(page: np.ndarray, degrees: float) -> np.ndarray:
    h, w = page.shape
    a = np.deg2rad(degrees)
    y, x = np.mgrid[:h, :w].astype(float)
    y, x = y - (h - 1) / 2, x - (w - 1) / 2
    return sampled(page, y * np.cos(a) + x * np.sin(a) + (h - 1) / 2, x * np.cos(a) - y * np.sin(a) + (w - 1) / 2)


def resized(page: np.ndarray, h: int, w: int) -> np.ndarray:
    y = (np.arange(h) + 0.5) * page.shape[0] / h - 0.5
    x = (np.arange(w) + 0.5) * page.shape[1] / w - 0.5
    y, x = np.clip(y, 0, page.shape[0] - 1), np.clip(x, 0, page.shape[1] - 1)
    return sampled(page, *np.meshgrid(y, x, indexing="ij"))


def coarse(page: np.ndarray, scale: float) -> np.ndarray:
    h, w = page.shape
    return resized(resized(page, max(1, int(h * scale)), max(1, int(w * scale))), h, w)


def otsu_level(page: np.ndarray) -> int:
    """The level that parts dark from light with the greatest variance between them; 128 for an empty page."""
    n = np.bincount(page.ravel(), minlength=256).astype(float)
    if not n.sum():
        return 128
    below, mass = n.cumsum(), (n * np.arange(256)).cumsum()
    above = n.sum() - below
    ok = (below > 0) & (above > 0)
    apart = np.zeros(256)
    apart[ok] = below[ok] * above[ok] * (mass[ok] / below[ok] - (mass[-1] - mass[ok]) / above[ok]) ** 2
    return int(apart.argmax())


def _waves() -> np.ndarray:
    k = np.arange(BLOCK)
    m = np.cos((2 * k[None] + 1) * k[:, None] * np.pi / (2 * BLOCK)) * np.sqrt(2 / BLOCK)
    m[0] /= np.sqrt(2)
    return m


def lossy(page: np.ndarray, quality: int) -> np.ndarray:
    """Cosine coefficients of blocks, rounded to steps that grow with frequency and with lower quality."""
    h, w = page.shape
    padded = np.pad(page.astype(float) - 128, ((0, -h % BLOCK), (0, -w % BLOCK)), mode="edge")
    tiles = padded.reshape(padded.shape[0] // BLOCK, BLOCK, -1, BLOCK).swapaxes(1, 2)
    m = _waves()
    k = np.arange(BLOCK)
    step = np.maximum(1.0, (16 + 8.0 * (k[:, None] + k[None])) * (50 / quality if quality < 50 else 2 - quality / 50))
    back = m.T @ (np.rint(m @ tiles @ m.T / step) * step) @ m
    return np.clip(np.rint(back.swapaxes(1, 2).reshape(padded.shape)[:h, :w] + 128), 0, 255).astype(np.uint8)


def damaged(page: np.ndarray, damage: Damage, seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    if damage.bleed > 0:
        page = show_through(page, damage.bleed)
    if damage.degrees:
        page = askew(page, damage.degrees)
    if damage.scale is not None and 0 < damage.scale < 1:
        page = coarse(page, damage.scale)
    if damage.sigma > 0:
        page = np.clip(page + rng.normal(0, damage.sigma, page.shape), 0, 255).astype(np.uint8)
    if damage.specks > 0:
        draw = rng.random(page.shape)
        page = np.where(draw < damage.specks / 2, 0, np.where(draw > 1 - damage.specks / 2, 255, page)).astype(np.uint8)
    if damage.fax:
        page = np.where(page >= otsu_level(page), 255, 0).astype(np.uint8)
    return page if damage.stored is None else lossy(page, damage.stored)


def degrade(pages: DataFrame, level: str = "medium", seed: int = 0) -> DataFrame:
    """``pages`` (doc_id, page, width, raster) with damaged rasters; every page draws from seed + page. An unknown level is an error."""
    damage = LEVELS[level]
    names = pages.columns

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for raw, width, page in zip(pdf.raster, pdf.width, pdf.page):
                grey = np.frombuffer(raw or b"", np.uint8).reshape(-1, max(1, int(width)))
                out.append(damaged(grey, damage, seed + int(page)).tobytes() if grey.size else b"")
            yield pdf.assign(raster=out)[names]

    return pages.mapInPandas(run, pages.schema)
