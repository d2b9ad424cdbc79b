"""G-16 multilevel B-spline surface against a brute-force implementation of the same algorithm."""

import random

import numpy as np

from pelagic.operators.surface import bspline_surface


def _B(t):
    return np.array([(1 - t) ** 3 / 6, (3 * t ** 3 - 6 * t ** 2 + 4) / 6, (-3 * t ** 3 + 3 * t ** 2 + 3 * t + 1) / 6,
                     t ** 3 / 6])


def _brute(x, y, z, gx, gy, mx, my, h):
    xmin, xmax, ymin, ymax = x.min(), x.max(), y.min(), y.max()
    r = z.astype(float).copy()
    out = np.zeros(len(gx))
    for k in range(h):
        kx, ky = mx * 2 ** k, my * 2 ** k

        def fan(px, py):
            u = (px - xmin) / (xmax - xmin) * kx
            v = (py - ymin) / (ymax - ymin) * ky
            fu, fv = min(np.floor(u), kx - 1), min(np.floor(v), ky - 1)
            return int(fu) - 1, int(fv) - 1, _B(u - fu), _B(v - fv)

        num, den = {}, {}
        for px, py, pr in zip(x, y, r):
            i0, j0, bs, bt = fan(px, py)
            w2 = (bs ** 2).sum() * (bt ** 2).sum()
            for a in range(4):
                for c in range(4):
                    w = bs[a] * bt[c]
                    key = (i0 + a, j0 + c)
                    num[key] = num.get(key, 0.0) + w * w * (w * pr / w2)
                    den[key] = den.get(key, 0.0) + w * w
        lat = {key: num[key] / den[key] for key in num if den[key] > 0}

        def ev(px, py):
            i0, j0, bs, bt = fan(px, py)
            return sum(bs[a] * bt[c] * lat.get((i0 + a, j0 + c), 0.0) for a in range(4) for c in range(4))

        r = r - np.array([ev(px, py) for px, py in zip(x, y)])
        out += np.array([ev(px, py) for px, py in zip(gx, gy)])
    return out


def test_surface_matches_brute_force(spark):
    rnd = random.Random(11)
    pts = [(rnd.uniform(0, 10), rnd.uniform(0, 50), 0.0) for _ in range(60)]
    pts = [(x, y, float(20 - 0.1 * y + np.sin(x))) for x, y, _ in pts]
    df = spark.createDataFrame(pts, "x double, y double, z double")
    nx, ny, mx, my, h = 7, 5, 1, 2, 3
    got = bspline_surface(df, "x", "y", "z", nx=nx, ny=ny, mx=mx, my=my, levels=h).orderBy("gx", "gy").collect()
    x, y, z = (np.array(c) for c in zip(*pts))
    gxs = [x.min() + (x.max() - x.min()) * r.gx / (nx - 1) for r in got]
    gys = [y.min() + (y.max() - y.min()) * r.gy / (ny - 1) for r in got]
    exp = _brute(x, y, z, np.array(gxs), np.array(gys), mx, my, h)
    assert len(got) == nx * ny
    assert np.allclose([r.z for r in got], exp, atol=1e-9)


def test_surface_by_group_fits_data(spark):
    rows = [(g, float(i % 9), float(i // 9), 3.0 + g * 2.0 + 0.5 * (i % 9)) for g in (0, 1) for i in range(81)]
    df = spark.createDataFrame(rows, "g int, x double, y double, z double")
    out = {(r.g, r.gx, r.gy): r.z for r in bspline_surface(df, "x", "y", "z", by=["g"], nx=9, ny=9, levels=5).collect()}
    # grid nodes coincide with the data: after 5 levels the surface reproduces them closely
    for g, x, y, z in rows:
        assert abs(out[(g, int(x), int(y))] - z) < 0.05


def test_surface_works_on_places_not_points(spark, monkeypatch):
    """Repeated readings of a place are merged once, with the surface of all of them."""
    from pelagic.operators import surface

    rnd = random.Random(3)
    pts = [(float(i % 5), float(i % 4), rnd.uniform(0, 9)) for i in range(200)]
    held, lattice = [], surface._lattice
    monkeypatch.setattr(surface, "_lattice", lambda rows, by: (held.append(rows.count()), lattice(rows, by))[1])
    got = bspline_surface(spark.createDataFrame(pts, "x double, y double, z double"), "x", "y", "z", nx=4, ny=3, mx=1, my=2, levels=2).collect()
    assert held == [20, 20]
    x, y, z = (np.array(c) for c in zip(*pts))
    exp = _brute(x, y, z, np.array([4.0 * r.gx / 3 for r in got]), np.array([3.0 * r.gy / 2 for r in got]), 1, 2, 2)
    assert np.allclose([r.z for r in got], exp, atol=1e-9)
