"""Image kernels on images whose answer is plain, and the way from files to metrics."""

import struct
import zlib

import numpy as np
import pytest

from plumbline.operators import geometry as G
from plumbline.operators import images
from plumbline.session import ship
from plumbline.sources import tables


def png(path, rgb):
    """A PNG file of rows of red, green, blue."""
    part = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    rows = b"".join(b"\0" + r.tobytes() for r in rgb)
    head = struct.pack(">IIBBBBB", rgb.shape[1], rgb.shape[0], 8, 2, 0, 0, 0)
    path.write_bytes(b"\x89PNG\r\n\x1a\n" + part(b"IHDR", head) + part(b"IDAT", zlib.compress(rows)) + part(b"IEND", b""))


def lettered():
    """Dark blocks of a letter's size on white."""
    grey = np.full((270, 180), 240, np.uint8)
    for k in range(6):
        grey[200:212, 20 + 22 * k : 30 + 22 * k] = 10
    return grey


def test_components_against_a_walk():
    r = np.random.default_rng(1)
    for _ in range(20):
        mask = r.random((17, 23)) < 0.45
        label, n = G.components(mask)
        seen = np.full(mask.shape, -1)
        count = 0
        for start in zip(*np.nonzero(mask), strict=True):
            if seen[start] >= 0:
                continue
            todo = [start]
            seen[start] = count
            while todo:
                y, x = todo.pop()
                for v in range(max(y - 1, 0), min(y + 2, 17)):
                    for u in range(max(x - 1, 0), min(x + 2, 23)):
                        if mask[v, u] and seen[v, u] < 0:
                            seen[v, u] = count
                            todo.append((v, u))
            count += 1
        assert n == count and (label == seen).all()
        wide = G.dilated(mask, 3, 5)
        assert all(wide[y, x] == mask[max(y - 1, 0) : y + 2, max(x - 2, 0) : x + 3].any() for y in range(17) for x in range(23))


def test_flat_image_has_nothing():
    m = G.measured(np.full((300, 200, 3), 128, np.uint8))
    assert (m["symmetry"], m["neg_space"], m["complexity"], m["text_area"], m["text_regions"], m["n_blocks"], m["diagonal_score"]) == (1, 1, 0, 0, 0, 0, 0)
    assert [m[c] for c in ("text_y", "align_score", "thirds_dist", "balance", "harmony")] == [None] * 5


def test_letters_and_blocks():
    grey = lettered()
    found = G.text_boxes(grey)
    assert found.tolist() == [[20 + 22 * k, 200, 30 + 22 * k, 212] for k in range(6)]
    m = G.typography(found, grey.shape)
    assert m["text_regions"] == 6 and m["text_area"] == pytest.approx(720 / grey.size, abs=1e-4) and m["text_y"] == pytest.approx(205.5 / 270, abs=1e-4)
    # the letters make one block, and none of them covers a hundredth of the image
    assert G.layout(grey, found) == {"align_score": None, "thirds_dist": None, "n_blocks": 1}
    grey[40:120, 80:160] = 10
    m = G.layout(grey, G.text_boxes(grey))
    assert m["n_blocks"] == 2 and m["align_score"] is not None and m["thirds_dist"] == pytest.approx(np.hypot(2 / 3 - 120 / 180, 1 / 3 - 80 / 270), abs=0.02)
    boxes = np.array([[0, 0, 10, 10], [20, 0, 30, 10], [0, 50, 10, 60]])
    lines = [[v[k] for v in boxes.tolist()] if k < 4 else [(v[k - 4] + v[k - 2]) / 2 for v in boxes.tolist()] for k in range(6)]
    want = [min(abs(a - b) for j, b in enumerate(line) if j != i) / (100 if k % 2 == 0 else 200) for k, line in enumerate(lines) for i, a in enumerate(line)]
    assert G.alignment(boxes, 100, 200) == pytest.approx(np.mean(want), abs=1e-4)


def test_lines():
    level, slanted = np.full((300, 200), 255, np.uint8), np.full((300, 200), 255, np.uint8)
    for y in range(20, 300, 40):
        level[y : y + 2, 10:190] = 0
    for x in range(10, 190):
        slanted[x : x + 3, x] = 0
    assert G.diagonal_score(G.edges(level)) < 0.1 and G.diagonal_score(G.edges(slanted)) > 0.5
    assert max(n for n, _ in G.segments(G.edges(level))) == pytest.approx(180, abs=4)


def test_balance_and_harmony():
    corner = np.zeros((180, 180), np.uint8)
    corner[10:30, 10:30] = 255
    middle = np.roll(corner, (70, 70), (0, 1))
    assert G.balance(middle) < 0.1 < G.balance(corner)
    two = np.zeros((100, 90, 3), np.uint8)
    two[:, :45, 2], two[:, 45:, 0] = 200, 200  # red and blue: 120 degrees apart
    assert G.harmony(two) == 1.0
    two[:, 45:, 1], two[:, 45:, 2], two[:, 45:, 0] = 200, 200, 0  # red and yellow: 60 degrees, 30 off a scheme
    assert G.harmony(two) == pytest.approx(1 - 30 / 180, abs=1e-4)


def test_files_to_metrics(spark, tmp_path):
    ship(spark)
    red = np.zeros((60, 40, 3), np.uint8)
    red[:, :, 0] = 200
    png(tmp_path / "red.png", red)
    png(tmp_path / "noise.png", np.random.default_rng(0).integers(0, 255, (600, 400, 3), dtype=np.uint8))
    (tmp_path / "broken.png").write_bytes(b"no image")
    found = tables.images(spark, str(tmp_path))
    got = {r["id"]: r for r in images.colours(found).collect()}
    assert set(got) == {"red", "noise", "broken"} and got["red"]["error"] is None
    assert got["broken"]["error"] and got["broken"]["brightness"] is None and got["broken"]["palette"] is None
    assert got["red"]["red_share"] == 1.0 and got["red"]["band_red"] == 1.0 and got["red"]["palette_share"] == [1.0]
    shade = got["red"]["palette"][0]
    assert abs(int(shade[1:3], 16) - 200) <= 2 and int(shade[3:5], 16) <= 2 and int(shade[5:7], 16) <= 2
    assert len(got["noise"]["palette"]) == 5 and abs(sum(got["noise"]["palette_share"]) - 1) < 0.01
    shape = {r["id"]: r for r in G.image_composition(found).collect()}
    assert shape["broken"]["error"] and shape["red"]["error"] is None and shape["red"]["neg_space"] == 1.0
    noise = shape["noise"].asDict()
    assert noise["error"] is None and all(noise[c.split()[0]] is not None for c in G.FIELDS.split(", ") if not c.startswith("text_y"))
