"""Image geometry by numpy inside tasks: one decoded image in, one row of composition metrics out.

The kernels are written here for numpy: traced edges, stable regions, line segments and spectral saliency. They follow the
usual definitions, not the arithmetic of any image library, so values compare between images and not digit by digit with
files made elsewhere. Images come from Spark's image source, so Spark splits and schedules them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

FIELDS = (
    "symmetry double, neg_space double, complexity double, mass_y double, mass_x double, text_area double, text_y double, text_regions int, "
    "align_score double, thirds_dist double, n_blocks int, balance double, harmony double, diagonal_score double, pyramid_shift double"
)
#: Images are brought to this width before anything is measured.
WIDTH = 180
# Thresholds of traced edges, of line segments (votes, gap, share of the shorter side), and angles of diagonals.
WEAK, STRONG = 60, 140
VOTES, GAP, SHORTEST = 25, 6, 0.12
DIAGONAL = (25, 65)
# Sizes of text regions, how far thresholds move and how little a stable region may change.
REGION, STEP, CHANGE = (15, 2000), 5, 0.25
# Angles between hues that count as harmonious.
SCHEMES = (30, 90, 120, 180)


def resized(image: np.ndarray, height: int, width: int) -> np.ndarray:
    """Box means of an image with as many rows and columns as asked for."""
    rows = np.linspace(0, image.shape[0], height + 1)
    columns = np.linspace(0, image.shape[1], width + 1)
    total = np.pad(np.cumsum(np.cumsum(image.astype(float), 0), 1), ((1, 0), (1, 0)))

    def at(ys: np.ndarray, xs: np.ndarray) -> np.ndarray:
        y0, x0 = np.minimum(ys.astype(int), image.shape[0] - 1), np.minimum(xs.astype(int), image.shape[1] - 1)
        fy, fx = (ys - y0)[:, None], (xs - x0)[None, :]
        top = total[np.ix_(y0, x0)] * (1 - fx) + total[np.ix_(y0, x0 + 1)] * fx
        return top * (1 - fy) + (total[np.ix_(y0 + 1, x0)] * (1 - fx) + total[np.ix_(y0 + 1, x0 + 1)] * fx) * fy

    whole = at(rows, columns)
    return (whole[1:, 1:] - whole[:-1, 1:] - whole[1:, :-1] + whole[:-1, :-1]) / (np.diff(rows)[:, None] * np.diff(columns)[None, :])


def sobel(grey: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradients along x and y, edges mirrored without repeating the border."""
    p = np.pad(grey.astype(float), 1, mode="reflect") if min(grey.shape) > 1 else np.pad(grey.astype(float), 1, mode="edge")
    smooth = lambda a, b, c: a + 2 * b + c
    gx = smooth(p[:-2, 2:] - p[:-2, :-2], p[1:-1, 2:] - p[1:-1, :-2], p[2:, 2:] - p[2:, :-2])
    gy = smooth(p[2:, :-2] - p[:-2, :-2], p[2:, 1:-1] - p[:-2, 1:-1], p[2:, 2:] - p[:-2, 2:])
    return gx, gy


def gradient(grey: np.ndarray) -> np.ndarray:
    return np.hypot(*sobel(grey))


def shifted(a: np.ndarray, dy: int, dx: int, fill) -> np.ndarray:
    """a[y + dy, x + dx], with fill outside."""
    out = np.full_like(a, fill)
    h, w = a.shape
    out[max(-dy, 0) : h - max(dy, 0), max(-dx, 0) : w - max(dx, 0)] = a[max(dy, 0) : h - max(-dy, 0), max(dx, 0) : w - max(-dx, 0)]
    return out


def dilated(mask: np.ndarray, height: int, width: int) -> np.ndarray:
    """Ones within a box of odd sides around a one; by running sums, first down and then across."""
    for axis, size in ((0, height), (1, width)):
        ends = [(0, 0), (0, 0)]
        ends[axis] = (size // 2 + 1, size // 2)
        total = np.cumsum(np.pad(mask.astype(np.int32), ends), axis)
        n = mask.shape[axis]
        mask = (np.take(total, range(size, size + n), axis) - np.take(total, range(n), axis)) > 0
    return mask


def components(mask: np.ndarray) -> tuple[np.ndarray, int]:
    """(number of each pixel's component from 0, or -1; how many there are), pixels touching at corners too.

    Each round a pixel takes the least label around it and then its label's own label, so rounds follow the logarithm of the longest way.
    """
    none = mask.size
    label = np.where(mask, np.arange(none).reshape(mask.shape), none)
    while True:
        near = label
        near = np.minimum(near, np.minimum(shifted(near, 1, 0, none), shifted(near, -1, 0, none)))
        near = np.where(mask, np.minimum(near, np.minimum(shifted(near, 0, 1, none), shifted(near, 0, -1, none))), none)
        root = np.append(near.ravel(), none)
        near = root[root[near]]
        if (near == label).all():
            break
        label = near
    names, at = np.unique(label[mask], return_inverse=True)
    out = np.full(mask.shape, -1)
    out[mask] = at
    return out, len(names)


def boxes_of(label: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(x0, y0, x1, y1) around each component, the ends left out, and its pixels."""
    y, x = np.nonzero(label >= 0)
    k = label[y, x]
    box = np.stack([np.full(n, label.shape[1]), np.full(n, label.shape[0]), np.zeros(n, int), np.zeros(n, int)], 1)
    for column, how, v in ((0, np.minimum, x), (1, np.minimum, y), (2, np.maximum, x + 1), (3, np.maximum, y + 1)):
        how.at(box[:, column], k, v)
    return box, np.bincount(k, minlength=n)


def edges(grey: np.ndarray) -> np.ndarray:
    """Traced edges: crests of the gradient over WEAK that touch, over other such ones, one over STRONG."""
    gx, gy = sobel(grey)
    size = np.abs(gx) + np.abs(gy)
    angle = np.degrees(np.arctan2(gy, gx)) % 180
    crest = np.zeros(grey.shape, bool)
    for middle, (dy, dx) in ((0, (0, 1)), (45, (1, 1)), (90, (1, 0)), (135, (1, -1))):
        off = np.abs(angle - middle)
        here = np.minimum(off, 180 - off) <= 22.5
        crest |= here & (size > shifted(size, -dy, -dx, 0.0)) & (size >= shifted(size, dy, dx, 0.0))
    label, n = components(crest & (size > WEAK))
    strong = np.zeros(n + 1, bool)
    strong[label[crest & (size > STRONG)]] = True
    return strong[label] & (label >= 0)


class Regions:
    """The component tree of a picture: all components of pixels up to each of the 256 levels, pixels touching at corners too.

    Pairs of neighbours are joined by union-find in the order of the level at which both are there; a component that gets pixels at
    a level is a node, the components that it swallows are its children. So one pass gives what thresholds at all levels give.
    """

    def __init__(self, tone: np.ndarray):
        height, width = tone.shape
        flat, place = tone.ravel().astype(int), np.arange(tone.size).reshape(tone.shape)
        ways = ((np.s_[:, :-1], np.s_[:, 1:]), (np.s_[:-1], np.s_[1:]), (np.s_[:-1, :-1], np.s_[1:, 1:]), (np.s_[:-1, 1:], np.s_[1:, :-1]))
        one, two = (np.concatenate([place[w[k]].ravel() for w in ways]) for k in (0, 1))
        meet = np.maximum(flat[one], flat[two])
        order = np.argsort(meet, kind="stable")
        one, two, edge = one[order].tolist(), two[order].tolist(), np.searchsorted(meet[order], np.arange(257)).tolist()
        pixels = np.argsort(flat, kind="stable")
        first = np.searchsorted(flat[pixels], np.arange(257)).tolist()
        ys, xs, pixels = (pixels // width).tolist(), (pixels % width).tolist(), pixels.tolist()
        self.size, self.level, self.area, self.box, self.parent, self.recent = tone.size, [], [], [], [], []
        up, inside = list(range(tone.size)), [[] for _ in range(tone.size)]

        def root(p: int) -> int:
            while up[p] != p:
                up[p] = up[up[p]]
                p = up[p]
            return p

        for level in range(256):
            for k in range(edge[level], edge[level + 1]):
                a, b = root(one[k]), root(two[k])
                if a != b:
                    if len(inside[a]) < len(inside[b]):
                        a, b = b, a
                    up[b] = a
                    inside[a] += inside[b]
                    inside[b] = []
            new: dict[int, int] = {}
            for k in range(first[level], first[level + 1]):
                r = root(pixels[k])
                node = new.get(r)
                if node is None:
                    node = new[r] = len(self.level)
                    self.level.append(level)
                    self.area.append(0)
                    self.box.append([width, height, 0, 0])
                    self.parent.append(-1)
                    self.recent.append({level: 0})
                self.area[node] += 1
                self.recent[node][level] += 1
                b, x, y = self.box[node], xs[k], ys[k]
                b[0], b[1], b[2], b[3] = min(b[0], x), min(b[1], y), max(b[2], x + 1), max(b[3], y + 1)
            for r, node in new.items():
                b = self.box[node]
                for child in inside[r]:
                    self.parent[child] = node
                    self.area[node] += self.area[child]
                    c = self.box[child]
                    b[0], b[1], b[2], b[3] = min(b[0], c[0]), min(b[1], c[1]), max(b[2], c[2]), max(b[3], c[3])
                    for v, n in self.recent[child].items():  # pixels of the last STEP levels
                        if v > level - STEP:
                            self.recent[node][v] = self.recent[node].get(v, 0) + n
                inside[r] = [node]

    def stable(self, node: int) -> bool:
        """Whether at one of its levels the region gains and loses few pixels when the level moves by STEP."""
        last = 256 if self.parent[node] < 0 else self.level[self.parent[node]]
        above = node
        for level in range(self.level[node], last):
            while self.parent[above] >= 0 and self.level[self.parent[above]] <= level + STEP:
                above = self.parent[above]
            core = self.area[node] - sum(n for v, n in self.recent[node].items() if v > level - STEP)
            if self.area[above] - core < CHANGE * self.area[node]:
                return True
        return False


def text_boxes(grey: np.ndarray) -> np.ndarray:
    """Boxes (x0, y0, x1, y1) of regions that look like letters: darker or lighter than what is around them, of about one size
    while the threshold moves, small, and neither very tall nor very wide. A heuristic, not reading."""
    height, width = grey.shape
    found: set[tuple[int, ...]] = set()
    for tone in (grey.astype(int), 255 - grey.astype(int)):
        regions = Regions(tone)
        for node, (area, box) in enumerate(zip(regions.area, regions.box, strict=True)):
            w, h = box[2] - box[0], box[3] - box[1]
            fit = REGION[0] <= area <= REGION[1] and area < regions.size and 4 <= h <= height * 0.12 and w < width * 0.9 and 0.1 < w / h < 12
            if fit and tuple(box) not in found and regions.stable(node):
                found.add(tuple(box))
    return np.array(sorted(found), int).reshape(-1, 4)


def covered(boxes: np.ndarray, shape: tuple[int, int]) -> np.ndarray:
    mask = np.zeros(shape, bool)
    for x0, y0, x1, y1 in boxes.tolist():
        mask[y0:y1, x0:x1] = True
    return mask


def typography(boxes: np.ndarray, shape: tuple[int, int]) -> dict[str, float | int | None]:
    mask = covered(boxes, shape)
    rows = np.flatnonzero(mask.any(1))
    return {"text_area": round(float(mask.mean()), 4), "text_y": round(float(rows.mean()) / shape[0], 4) if len(rows) else None, "text_regions": len(boxes)}


def alignment(boxes: np.ndarray, width: int, height: int) -> float | None:
    """Mean distance of each box's edge and middle lines to the nearest such line of another box; null for fewer than two."""
    if len(boxes) < 2:
        return None
    every = []
    for low, high, size in ((0, 2, width), (1, 3, height)):
        for at in (boxes[:, low], (boxes[:, low] + boxes[:, high]) / 2, boxes[:, high]):
            step = np.diff(np.sort(at / size))
            every.append(np.minimum(np.r_[step, np.inf], np.r_[np.inf, step]))
    return round(float(np.mean(every)), 4)


def layout(grey: np.ndarray, letters: np.ndarray) -> dict[str, float | int | None]:
    """Blocks: letters that lie near each other, and the largest busy area if it covers a hundredth of the image."""
    height, width = grey.shape
    box, area = boxes_of(*components(dilated(covered(letters, grey.shape), 5, 15)))
    blocks = box[area >= 25]
    busy, size = boxes_of(*components(dilated(gradient(grey) > 25, 7, 7)))
    main = busy[size.argmax()] if len(size) and size.max() >= 0.01 * grey.size else None
    if main is not None:
        blocks = np.vstack([blocks, main])
    third = None if main is None else round(thirds_distance(tuple(main.tolist()), width, height), 4)
    return {"align_score": alignment(blocks, width, height), "thirds_dist": third, "n_blocks": len(blocks)}


def smoothed(a: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """a under a symmetric kernel along both axes, borders repeated."""
    r = len(weights) // 2
    p = np.pad(a, r, mode="edge")
    p = sum(w * p[k : k + a.shape[0]] for k, w in enumerate(weights))
    return sum(w * p[:, k : k + a.shape[1]] for k, w in enumerate(weights))


def balance(grey: np.ndarray) -> float | None:
    """Distance of the middle of the spectral residual's saliency from the image's middle, in shares; null for a flat image."""
    if grey.min() == grey.max():
        return None
    wave = np.fft.fft2(resized(grey, 64, 64))
    size = np.log(np.abs(wave) + 1e-9)
    rest = np.exp(size - smoothed(size, np.full(3, 1 / 3)) + 1j * np.angle(wave))
    blur = np.exp(-(np.arange(-2, 3) ** 2) / 128)
    map_ = smoothed(np.abs(np.fft.ifft2(rest)) ** 2, blur / blur.sum())
    y, x = (np.indices(map_.shape) + 0.5) / 64
    return round(float(np.hypot((x * map_).sum() / map_.sum() - 0.5, (y * map_).sum() / map_.sum() - 0.5)), 4)


def harmony(bgr: np.ndarray) -> float | None:
    """How near the pairs of up to three strong hues (over 3 % of the pixels) are to the SCHEMES; null for fewer than two. Grey has hue 0."""
    b, g, r = np.moveaxis(bgr.astype(float), 2, 0)
    most = np.maximum(np.maximum(r, g), b)
    d = most - np.minimum(np.minimum(r, g), b)
    safe = np.where(d > 0, d, 1)
    hue = np.where(d == 0, 0, np.where(most == r, (g - b) / safe * 60, np.where(most == g, (b - r) / safe * 60 + 120, (r - g) / safe * 60 + 240))) % 360
    n = np.bincount((hue // 10).astype(int).ravel(), minlength=36)
    peaks = np.argsort(n, kind="stable")[-3:]
    at = np.sort(peaks[n[peaks] > n.sum() * 0.03] * 10.0)
    if len(at) < 2:
        return None
    i, j = np.triu_indices(len(at), 1)
    apart = np.minimum(at[j] - at[i], 360 - (at[j] - at[i]))
    return round(1 - float((np.abs(apart[:, None] - np.array(SCHEMES)).min(1) / 180).mean()), 4)


def segments(edge: np.ndarray) -> list[tuple[float, int]]:
    """(length, degrees off horizontal) of straight runs of edge pixels: the line with most votes first, whose pixels then no longer vote."""
    y, x = np.nonzero(edge)
    turn = np.radians(np.arange(180))
    far = int(np.hypot(*edge.shape)) + 2
    rho = np.round(x[:, None] * np.cos(turn) + y[:, None] * np.sin(turn)).astype(int) + far
    cell = rho + np.arange(180) * 2 * far
    votes = np.bincount(cell.ravel(), minlength=360 * far)
    live = np.ones(len(y), bool)
    shortest = int(min(edge.shape) * SHORTEST)
    out: list[tuple[float, int]] = []
    while len(y) and votes.max() >= VOTES:
        best = int(votes.argmax())
        t, at = divmod(best, 2 * far)
        on = np.flatnonzero(live & (np.abs(rho[:, t] - at) <= 1))
        along = y[on] * np.cos(turn[t]) - x[on] * np.sin(turn[t])
        on, along = on[np.argsort(along)], np.sort(along)
        cut = np.r_[0, np.flatnonzero(np.diff(along) > GAP) + 1, len(on)]
        used = [(i, j) for i, j in zip(cut, cut[1:], strict=False) if j > i and along[j - 1] - along[i] >= shortest]
        for i, j in used:
            out.append((float(along[j - 1] - along[i]), abs(90 - t)))
            live[on[i:j]] = False
            votes -= np.bincount(cell[on[i:j]].ravel(), minlength=len(votes))
        votes[best] = 0
    return out


def diagonal_score(edge: np.ndarray) -> float:
    found = segments(edge)
    total = sum(n for n, _ in found)
    return round(sum(n for n, a in found if DIAGONAL[0] <= a <= DIAGONAL[1]) / total, 4) if total else 0.0


def spread(magnitude: np.ndarray) -> float:
    """Twice the deviation of the columns' weight, as a share of the width."""
    band = magnitude.sum(0)
    if band.sum() < 1e-6:
        return 0.0
    x = np.arange(len(band))
    centre = (x * band).sum() / band.sum()
    return float(2 * np.sqrt(((x - centre) ** 2 * band).sum() / band.sum()) / len(band))


def thirds_distance(box: tuple[float, float, float, float], width: int, height: int) -> float:
    """Distance of a box's middle from the nearest third point, in shares."""
    cx, cy = (box[0] + box[2]) / 2 / width, (box[1] + box[3]) / 2 / height
    return float(min(np.hypot(cx - px, cy - py) for px in (1 / 3, 2 / 3) for py in (1 / 3, 2 / 3)))


def composition(grey: np.ndarray, edge: np.ndarray | None = None) -> dict[str, float]:
    small = np.round(resized(grey, 96, 64))
    magnitude = gradient(grey)
    total = magnitude.sum() + 1e-9
    y, x = np.indices(magnitude.shape)
    lifted = np.clip(magnitude - 15, 0, None)
    third = grey.shape[0] // 3
    return {
        "symmetry": round(1 - float(np.abs(small - small[:, ::-1]).mean()) / 255, 4),
        "neg_space": round(float((magnitude < 8).mean()), 4),
        "complexity": round(float((edges(grey) if edge is None else edge).mean()), 4),
        "mass_y": round(float((y * magnitude).sum() / total) / grey.shape[0], 4),
        "mass_x": round(float((x * magnitude).sum() / total) / grey.shape[1], 4),
        "pyramid_shift": round(spread(lifted[2 * grey.shape[0] // 3 :]) - spread(lifted[:third]), 4),
    }


def measured(bgr: np.ndarray) -> dict[str, float | int | None]:
    """All columns of FIELDS of an image (rows of blue, green, red), first brought to WIDTH."""
    height = max(1, int(bgr.shape[0] * WIDTH / bgr.shape[1]))
    bgr = np.round(np.stack([resized(bgr[:, :, c], height, WIDTH) for c in range(3)], 2)).astype(np.uint8)
    grey = grey_of(height, WIDTH, 3, bgr.tobytes())
    edge, letters = edges(grey), text_boxes(grey)
    return {
        **composition(grey, edge), **typography(letters, grey.shape), **layout(grey, letters),
        "balance": balance(grey), "harmony": harmony(bgr), "diagonal_score": diagonal_score(edge),
    }


def bgr_of(height: int, width: int, channels: int, data: bytes) -> np.ndarray:
    """An image of Spark's image source as rows of blue, green, red; grey ones three times, without alpha."""
    pixels = np.frombuffer(data, np.uint8).reshape(height, width, channels)
    return np.repeat(pixels, 3, 2) if channels == 1 else pixels[:, :, :3]


def grey_of(height: int, width: int, channels: int, data: bytes) -> np.ndarray:
    """A grey image from the bytes of Spark's image source (rows of BGR)."""
    pixels = np.frombuffer(data, np.uint8).reshape(height, width, channels)
    if channels < 3:
        return pixels[:, :, 0]
    return np.round(pixels[:, :, 0] * 0.114 + pixels[:, :, 1] * 0.587 + pixels[:, :, 2] * 0.299).astype(np.uint8)


def image_composition(images: DataFrame) -> DataFrame:
    """Rows of Spark's image source (column `image`) to (id, metrics, error); a broken image gives its error as data."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for r in f.itertuples(index=False):
                try:
                    rows.append({"id": r.id, **measured(bgr_of(r.height, r.width, r.nChannels, r.data)), "error": None})
                except Exception as e:  # one image doesn't stop the batch
                    rows.append({"id": r.id, "error": str(e)[:200]})
            out = pd.DataFrame(rows, columns=["id", *[c.split()[0] for c in FIELDS.split(", ")], "error"])
            yield out.astype({"text_regions": "Int32", "n_blocks": "Int32"})

    flat = images.selectExpr("regexp_extract(image.origin, '([^/]+)[.][^./]+$', 1) as id", "image.height", "image.width", "image.nChannels", "image.data")
    return flat.mapInPandas(run, f"id string, {FIELDS}, error string")
