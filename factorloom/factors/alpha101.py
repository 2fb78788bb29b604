"""The implemented part of the "101 formulaic alphas", from their published formulas.

Fractional windows are rounded half up; advN is the mean volume of N rows; ``rank`` is the percent rank of the day.
A comparison that cannot be decided yet counts as false. Where noted, a missing correlation counts as 0.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import ts, xs
from ..functions.scalar import (div, flag, larger, less, ln, minus, nonzero, not_more, pick, power, sign, smaller)
from .staging import by_date, by_ticker, rank

scale = xs.scale


def or0(x):
    return F.coalesce(x, F.lit(0.0))


def below(x, y):
    """-1 where x < y, else 0."""
    return pick(less(x, y), -1.0, 0.0)


def f001(b):
    r = yield by_ticker(ts.change(b.C, 1))
    s = yield by_ticker(ts.std(r, 20))
    x = pick(r < 0, s, b.C)
    p = yield by_ticker(ts.argmax(x * x, 5))
    z = yield by_date(rank(p))
    return z - 0.5


def f002(b):
    d = yield by_ticker(ts.delta(ln(b.V), 2))
    x, y = yield by_date(rank(d), rank(div(b.C - b.O, b.O)))
    k = yield by_ticker(ts.corr(x, y, 6))
    return or0(-k)


def f003(b):
    x, y = yield by_date(rank(b.O), rank(b.V))
    k = yield by_ticker(ts.corr(x, y, 10))
    return or0(-k)


def f004(b):
    x = yield by_date(rank(b.L))
    z = yield by_ticker(ts.rank(x, 9))
    return -z


def f005(b):
    s = yield by_ticker(ts.total(b.W, 10))
    x, y = yield by_date(rank(b.O - s / 10), rank(b.C - b.W))
    return x * -F.abs(y)


def f006(b):
    k = yield by_ticker(ts.corr(b.O, b.V, 10))
    return or0(-k)


def f007(b):
    adv, d = yield by_ticker(ts.mean(b.V, 20), ts.delta(b.C, 7))
    t = yield by_ticker(ts.rank(F.abs(d), 60))
    return pick(not_more(b.V, adv), -1.0, -t * sign(d))


def f008(b):
    r = yield by_ticker(ts.change(b.C, 1))
    o, s = yield by_ticker(ts.total(b.O, 5), ts.total(r, 5))
    x = o * s
    old = yield by_ticker(ts.delay(x, 10))
    z = yield by_date(rank(x - old))
    return -z


def _trend(d, lo, hi):
    return pick(less(0.0, lo), d, pick(less(hi, 0.0), d, -d))


def f009(b):
    d = yield by_ticker(ts.delta(b.C, 1))
    lo, hi = yield by_ticker(ts.low(d, 5), ts.high(d, 5))
    return _trend(d, lo, hi)


def f010(b):
    d = yield by_ticker(ts.delta(b.C, 1))
    lo, hi = yield by_ticker(ts.low(d, 4), ts.high(d, 4))
    z = yield by_date(rank(_trend(d, lo, hi)))
    return z


def f011(b):
    hi, lo, d = yield by_ticker(ts.high(b.W - b.C, 3), ts.low(b.W - b.C, 3), ts.delta(b.V, 3))
    x, y, z = yield by_date(rank(hi), rank(lo), rank(d))
    return (x + y) * z


def f012(b):
    v, c = yield by_ticker(ts.delta(b.V, 1), ts.delta(b.C, 1))
    return sign(v) * -c


def _rank_cov(x, y):
    p, q = yield by_date(rank(x), rank(y))
    k = yield by_ticker(ts.cov(p, q, 5))
    z = yield by_date(rank(k))
    return -z


def f013(b):
    return (yield from _rank_cov(b.C, b.V))


def f014(b):
    r, k = yield by_ticker(ts.change(b.C, 1), ts.corr(b.O, b.V, 10))
    d = yield by_ticker(ts.delta(r, 3))
    z = yield by_date(rank(d))
    return -z * or0(k)


def f015(b):
    x, y = yield by_date(rank(b.H), rank(b.V))
    k = yield by_ticker(ts.corr(x, y, 3))
    z = yield by_date(rank(or0(k)))
    s = yield by_ticker(ts.total(z, 3))
    return -s


def f016(b):
    return (yield from _rank_cov(b.H, b.V))


def f017(b):
    t, d, adv = yield by_ticker(ts.rank(b.C, 10), ts.delta(b.C, 1), ts.mean(b.V, 20))
    dd, v = yield by_ticker(ts.delta(d, 1), ts.rank(div(b.V, adv), 5))
    x, y, z = yield by_date(rank(t), rank(dd), rank(v))
    return -x * y * z


def f018(b):
    s, k = yield by_ticker(ts.std(F.abs(b.C - b.O), 5), ts.corr(b.C, b.O, 10))
    z = yield by_date(rank(s + (b.C - b.O) + or0(k)))
    return -z


def f019(b):
    old, r = yield by_ticker(ts.delay(b.C, 7), ts.change(b.C, 1))
    s = yield by_ticker(ts.total(r, 250))
    z = yield by_date(rank(1 + s))
    return -sign((b.C - old) + (b.C - old)) * (1 + z)


def f020(b):
    h, c, l = yield by_ticker(ts.delay(b.H, 1), ts.delay(b.C, 1), ts.delay(b.L, 1))
    x, y, z = yield by_date(rank(b.O - h), rank(b.O - c), rank(b.O - l))
    return -x * y * z


def f021(b):
    m, s, m2, adv = yield by_ticker(ts.mean(b.C, 8), ts.std(b.C, 8), ts.mean(b.C, 2), ts.mean(b.V, 20))
    return pick(less(m + s, m2), -1.0,
                pick(less(m2, m - s), 1.0, pick(not_more(1.0, div(b.V, adv)), 1.0, -1.0)))


def f022(b):
    k, s = yield by_ticker(ts.corr(b.H, b.V, 5), ts.std(b.C, 20))
    d = yield by_ticker(ts.delta(or0(k), 5))
    z = yield by_date(rank(s))
    return -d * z


def f023(b):
    m, d = yield by_ticker(ts.mean(b.H, 20), ts.delta(b.H, 2))
    return pick(less(m, b.H), or0(-d), 0.0)


def f024(b):
    m, old, lo, d = yield by_ticker(ts.mean(b.C, 100), ts.delay(b.C, 100), ts.low(b.C, 100), ts.delta(b.C, 3))
    dm = yield by_ticker(ts.delta(m, 100))
    return pick(not_more(div(dm, old), 0.05), lo - b.C, -d)


def f025(b):
    r, adv = yield by_ticker(ts.change(b.C, 1), ts.mean(b.V, 20))
    z = yield by_date(rank(-r * adv * b.W * (b.H - b.C)))
    return z


def f026(b):
    v, h = yield by_ticker(ts.rank(b.V, 5), ts.rank(b.H, 5))
    k = yield by_ticker(ts.corr(v, h, 5))
    m = yield by_ticker(ts.high(or0(k), 3))
    return -m


def f027(b):
    x, y = yield by_date(rank(b.V), rank(b.W))
    k = yield by_ticker(ts.corr(x, y, 6))
    s = yield by_ticker(ts.total(k, 2))
    z = yield by_date(rank(s / 2))
    return F.when(less(0.5, z), -1.0).when(z.isNotNull(), 1.0)


def f028(b):
    adv = yield by_ticker(ts.mean(b.V, 20))
    k = yield by_ticker(ts.corr(adv, b.L, 5))
    z = yield by_date(scale(or0(k) + (b.H + b.L) / 2 - b.C))
    return z


def f029(b):
    d, r = yield by_ticker(ts.delta(b.C - 1, 5), ts.change(b.C, 1))
    x = yield by_date(rank(d))
    x = yield by_date(rank(-x))
    x = yield by_date(rank(x))
    lo, old = yield by_ticker(ts.low(x, 2), ts.delay(-r, 6))
    x = yield by_date(scale(ln(lo)))
    x = yield by_date(rank(x))
    x = yield by_date(rank(x))
    m, t = yield by_ticker(ts.low(x, 5), ts.rank(old, 5))
    return m + t


def _three_signs(b):
    c1, c2, c3 = yield by_ticker(ts.delay(b.C, 1), ts.delay(b.C, 2), ts.delay(b.C, 3))
    return sign(b.C - c1) + sign(c1 - c2) + sign(c2 - c3)


def f030(b):
    x = yield from _three_signs(b)
    z = yield by_date(rank(x))
    s5, s20 = yield by_ticker(ts.total(b.V, 5), ts.total(b.V, 20))
    return div((1 - z) * s5, s20)


def f031(b):
    d10, d3, adv = yield by_ticker(ts.delta(b.C, 10), ts.delta(b.C, 3), ts.mean(b.V, 20))
    x, y = yield by_date(rank(d10), rank(-d3))
    x = yield by_date(rank(x))
    w, k = yield by_ticker(ts.decay(-x, 10), ts.corr(adv, b.L, 12))
    w, s = yield by_date(rank(w), scale(or0(k)))
    w = yield by_date(rank(w))
    w = yield by_date(rank(w))
    return w + y + sign(s)


def f032(b):
    m, old = yield by_ticker(ts.mean(b.C, 7), ts.delay(b.C, 5))
    k = yield by_ticker(ts.corr(b.W, old, 230))
    x, y = yield by_date(scale(m - b.C), scale(k))
    return x + 20 * y


def f033(b):
    z = yield by_date(rank(div(b.O, b.C) - 1))
    return z


def f034(b):
    r, d = yield by_ticker(ts.change(b.C, 1), ts.delta(b.C, 1))
    s2, s5 = yield by_ticker(ts.std(r, 2), ts.std(r, 5))
    x, y = yield by_date(rank(F.coalesce(div(s2, s5), F.lit(1.0))), rank(d))
    z = yield by_date(rank((1 - x) + (1 - y)))
    return z


def f035(b):
    r, v, x = yield by_ticker(ts.change(b.C, 1), ts.rank(b.V, 32), ts.rank(b.C + b.H - b.L, 16))
    t = yield by_ticker(ts.rank(r, 32))
    return v * (1 - x) * (1 - t)


def f036(b):
    v, r, adv, m = yield by_ticker(ts.delay(b.V, 1), ts.change(b.C, 1), ts.mean(b.V, 20), ts.mean(b.C, 200))
    k1, old, k2 = yield by_ticker(ts.corr(b.C - b.O, v, 15), ts.delay(-r, 6), ts.corr(b.W, adv, 6))
    t = yield by_ticker(ts.rank(old, 5))
    p, q, s, u, x = yield by_date(rank(k1), rank(b.O - b.C), rank(t), rank(F.abs(k2)),
                                  rank((m - b.O) * (b.C - b.O)))
    return 2.21 * p + 0.7 * q + 0.73 * s + u + 0.6 * x


def f037(b):
    old = yield by_ticker(ts.delay(b.O - b.C, 1))
    k = yield by_ticker(ts.corr(old, b.C, 200))
    x, y = yield by_date(rank(k), rank(b.O - b.C))
    return x + y


def f038(b):
    t = yield by_ticker(ts.rank(b.C, 10))
    x, y = yield by_date(rank(t), rank(F.coalesce(div(b.C, b.O), F.lit(1.0))))
    return -x * y


def f039(b):
    d, adv, r = yield by_ticker(ts.delta(b.C, 7), ts.mean(b.V, 20), ts.change(b.C, 1))
    w, s = yield by_ticker(ts.decay(div(b.V, adv), 9), ts.total(r, 250))
    w, s = yield by_date(rank(w), rank(s))
    x = yield by_date(rank(d * (1 - w)))
    return -x * (1 + s)


def f040(b):
    s, k = yield by_ticker(ts.std(b.H, 10), ts.corr(b.H, b.V, 10))
    z = yield by_date(rank(s))
    return -z * k


def f041(b):
    return power(b.H * b.L, 0.5) - b.W


def f042(b):
    x, y = yield by_date(rank(b.W - b.C), rank(b.W + b.C))
    return div(x, y)


def f043(b):
    adv, d = yield by_ticker(ts.mean(b.V, 20), ts.delta(b.C, 7))
    x, y = yield by_ticker(ts.rank(div(b.V, adv), 20), ts.rank(-d, 8))
    return x * y


def f044(b):
    v = yield by_date(rank(b.V))
    k = yield by_ticker(ts.corr(b.H, v, 5))
    return or0(-k)


def f045(b):
    old, k, s5, s20 = yield by_ticker(ts.delay(b.C, 5), ts.corr(b.C, b.V, 2), ts.total(b.C, 5), ts.total(b.C, 20))
    m, k2 = yield by_ticker(ts.total(old, 20), ts.corr(s5, s20, 2))
    x, y = yield by_date(rank(m / 20), rank(k2))
    return -x * or0(k) * y


def _curve(b):
    c1, c10, c20 = yield by_ticker(ts.delay(b.C, 1), ts.delay(b.C, 10), ts.delay(b.C, 20))
    return (c20 - c10) / 10 - (c10 - b.C) / 10, b.C - c1


def f046(b):
    x, d = yield from _curve(b)
    return pick(less(0.25, x), -1.0, pick(less(x, 0.0), 1.0, -d))


def f047(b):
    adv, s, old = yield by_ticker(ts.mean(b.V, 20), ts.total(b.H, 5), ts.delay(b.W, 5))
    x, y, z = yield by_date(rank(div(1.0, b.C)), rank(b.H - b.C), rank(b.W - old))
    return div(x * b.V, adv) * div(b.H * y, s / 5) - z


def f049(b):
    x, d = yield from _curve(b)
    return pick(less(x, -0.1), 1.0, -d)


def f050(b):
    x, y = yield by_date(rank(b.V), rank(b.W))
    k = yield by_ticker(ts.corr(x, y, 5))
    z = yield by_date(rank(k))
    m = yield by_ticker(ts.high(z, 5))
    return -m


def f051(b):
    x, d = yield from _curve(b)
    return pick(less(x, -0.05), 1.0, -d)


def f052(b):
    lo, r, v = yield by_ticker(ts.low(b.L, 5), ts.change(b.C, 1), ts.rank(b.V, 5))
    old, s240, s20 = yield by_ticker(ts.delay(lo, 5), ts.total(r, 240), ts.total(r, 20))
    z = yield by_date(rank((s240 - s20) / 220))
    return (old - lo) * z * v


def f053(b):
    d = yield by_ticker(ts.delta(div((b.C - b.L) - (b.H - b.C), nonzero(b.C - b.L, 0.0001)), 9))
    return -d


def f054(b):
    return div(-(b.L - b.C) * power(b.O, 5), nonzero(b.L - b.H, -0.0001) * power(b.C, 5))


def f055(b):
    lo, hi = yield by_ticker(ts.low(b.L, 12), ts.high(b.H, 12))
    x, y = yield by_date(rank(div(b.C - lo, nonzero(hi - lo, 0.0001))), rank(b.V))
    k = yield by_ticker(ts.corr(x, y, 6))
    return or0(-k)


def f056(b):
    r = yield by_ticker(ts.change(b.C, 1))
    s10, s2 = yield by_ticker(ts.total(r, 10), ts.total(r, 2))
    s = yield by_ticker(ts.total(s2, 3))
    x, y = yield by_date(rank(div(s10, s)), rank(r * b.CAP))
    return -x * y


def f057(b):
    p = yield by_ticker(ts.argmax(b.C, 30))
    z = yield by_date(rank(p))
    w = yield by_ticker(ts.decay(z, 2))
    return -div(b.C - b.W, w)


def f060(b):
    p = yield by_ticker(ts.argmax(b.C, 10))
    x, y = yield by_date(rank(div(((b.C - b.L) - (b.H - b.C)) * b.V, nonzero(b.H - b.L, 0.0001))), rank(p))
    x, y = yield by_date(scale(x), scale(y))
    return minus(y, 2 * x)


def f061(b):
    lo, adv = yield by_ticker(ts.low(b.W, 16), ts.mean(b.V, 180))
    k = yield by_ticker(ts.corr(b.W, adv, 18))
    x, y = yield by_date(rank(b.W - lo), rank(k))
    return pick(less(x, y), 1.0, 0.0)


def f062(b):
    adv = yield by_ticker(ts.mean(b.V, 20))
    s = yield by_ticker(ts.total(adv, 22))
    k = yield by_ticker(ts.corr(b.W, s, 10))
    x, o, m, h = yield by_date(rank(k), rank(b.O), rank((b.H + b.L) / 2), rank(b.H))
    y = yield by_date(rank(pick(less(o + o, m + h), 1.0, 0.0)))
    return below(x, y)


def f064(b):
    adv, d = yield by_ticker(
        ts.mean(b.V, 120),
        ts.delta((b.H + b.L) / 2 * 0.178404 + b.W * (1 - 0.178404), 4))
    p, q = yield by_ticker(ts.total(b.O * 0.178404 + b.L * (1 - 0.178404), 13), ts.total(adv, 13))
    k = yield by_ticker(ts.corr(p, q, 17))
    x, y = yield by_date(rank(k), rank(d))
    return below(x, y)


def f065(b):
    adv, lo = yield by_ticker(ts.mean(b.V, 60), ts.low(b.O, 14))
    s = yield by_ticker(ts.total(adv, 9))
    k = yield by_ticker(ts.corr(b.O * 0.00817205 + b.W * (1 - 0.00817205), s, 6))
    x, y = yield by_date(rank(k), rank(b.O - lo))
    return below(x, y)


def f066(b):
    d, w = yield by_ticker(
        ts.delta(b.W, 4),
        ts.decay(div(b.L * 0.96633 + b.L * (1 - 0.96633) - b.W, b.O - (b.H + b.L) / 2), 11))
    d, t = yield by_ticker(ts.decay(d, 7), ts.rank(w, 7))
    x = yield by_date(rank(d))
    return -(x + t)


def f068(b):
    adv, d = yield by_ticker(ts.mean(b.V, 15), ts.delta(b.C * 0.518371 + b.L * (1 - 0.518371), 1))
    x, y, z = yield by_date(rank(b.H), rank(adv), rank(d))
    k = yield by_ticker(ts.corr(x, y, 9))
    t = yield by_ticker(ts.rank(k, 14))
    return below(t, z)


def f071(b):
    c, adv = yield by_ticker(ts.rank(b.C, 3), ts.mean(b.V, 180))
    adv = yield by_ticker(ts.rank(adv, 12))
    k = yield by_ticker(ts.corr(c, adv, 18))
    k = yield by_ticker(ts.decay(k, 4))
    k = yield by_ticker(ts.rank(k, 16))
    z = yield by_date(rank(b.L + b.O - (b.W + b.W)))
    w = yield by_ticker(ts.decay(z * z, 16))
    w = yield by_ticker(ts.rank(w, 4))
    return larger(k, w)


def f072(b):
    adv, w, v = yield by_ticker(ts.mean(b.V, 40), ts.rank(b.W, 4), ts.rank(b.V, 19))
    k1, k2 = yield by_ticker(ts.corr((b.H + b.L) / 2, adv, 9), ts.corr(w, v, 7))
    k1, k2 = yield by_ticker(ts.decay(k1, 10), ts.decay(k2, 3))
    x, y = yield by_date(rank(k1), rank(k2))
    return div(x, y)


def f073(b):
    m = b.O * 0.147155 + b.L * (1 - 0.147155)
    d, e = yield by_ticker(ts.delta(b.W, 5), ts.delta(m, 2))
    d, e = yield by_ticker(ts.decay(d, 3), ts.decay(-div(e, m), 3))
    t = yield by_ticker(ts.rank(e, 17))
    x = yield by_date(rank(d))
    return -larger(x, t)


def f074(b):
    adv = yield by_ticker(ts.mean(b.V, 30))
    s = yield by_ticker(ts.total(adv, 37))
    k = yield by_ticker(ts.corr(b.C, s, 15))
    x, p, q = yield by_date(rank(k), rank(b.H * 0.0261661 + b.W * (1 - 0.0261661)), rank(b.V))
    k = yield by_ticker(ts.corr(p, q, 11))
    y = yield by_date(rank(k))
    return below(x, y)


def f075(b):
    k, adv = yield by_ticker(ts.corr(b.W, b.V, 4), ts.mean(b.V, 50))
    x, p, q = yield by_date(rank(k), rank(b.L), rank(adv))
    k = yield by_ticker(ts.corr(p, q, 12))
    y = yield by_date(rank(k))
    return pick(less(x, y), 1.0, 0.0)


def f077(b):
    w, adv = yield by_ticker(ts.decay((b.H + b.L) / 2 + b.H - (b.W + b.H), 20), ts.mean(b.V, 40))
    k = yield by_ticker(ts.corr((b.H + b.L) / 2, adv, 3))
    k = yield by_ticker(ts.decay(k, 6))
    x, y = yield by_date(rank(w), rank(k))
    return smaller(x, y)


def f078(b):
    adv, p = yield by_ticker(ts.mean(b.V, 40), ts.total(b.L * 0.352233 + b.W * (1 - 0.352233), 20))
    q = yield by_ticker(ts.total(adv, 20))
    k = yield by_ticker(ts.corr(p, q, 7))
    x, w, v = yield by_date(rank(k), rank(b.W), rank(b.V))
    k = yield by_ticker(ts.corr(w, v, 6))
    y = yield by_date(rank(k))
    return power(x, y)


def f081(b):
    adv = yield by_ticker(ts.mean(b.V, 10))
    s = yield by_ticker(ts.total(adv, 50))
    k = yield by_ticker(ts.corr(b.W, s, 8))
    x, w, v = yield by_date(rank(k), rank(b.W), rank(b.V))
    x = yield by_date(rank(power(x, 4)))
    p, k = yield by_ticker(ts.prod(x, 15), ts.corr(w, v, 5))
    x, y = yield by_date(rank(ln(p)), rank(k))
    return below(x, y)


def f083(b):
    s = yield by_ticker(ts.total(b.C, 5))
    spread = div(b.H - b.L, s / 5)
    old = yield by_ticker(ts.delay(spread, 2))
    x, y = yield by_date(rank(old), rank(b.V))
    y = yield by_date(rank(y))
    return div(x * y, div(spread, b.W - b.C))


def f084(b):
    hi, d = yield by_ticker(ts.high(b.W, 15), ts.delta(b.C, 5))
    t = yield by_ticker(ts.rank(b.W - hi, 21))
    return power(t, d)


def f085(b):
    adv, m, v = yield by_ticker(ts.mean(b.V, 30), ts.rank((b.H + b.L) / 2, 4), ts.rank(b.V, 10))
    k1, k2 = yield by_ticker(ts.corr(b.H * 0.876703 + b.C * (1 - 0.876703), adv, 10), ts.corr(m, v, 7))
    x, y = yield by_date(rank(k1), rank(k2))
    return power(x, y)


def f086(b):
    adv = yield by_ticker(ts.mean(b.V, 20))
    s = yield by_ticker(ts.total(adv, 15))
    k = yield by_ticker(ts.corr(b.C, s, 6))
    t = yield by_ticker(ts.rank(k, 20))
    z = yield by_date(rank((b.O + b.C) - (b.W + b.O)))
    return below(t, z)


def f088(b):
    o, l, h, c = yield by_date(rank(b.O), rank(b.L), rank(b.H), rank(b.C))
    w, p, adv = yield by_ticker(ts.decay((o + l) - (h + c), 8), ts.rank(b.C, 8), ts.mean(b.V, 60))
    q = yield by_ticker(ts.rank(adv, 21))
    k = yield by_ticker(ts.corr(p, q, 8))
    k = yield by_ticker(ts.decay(k, 7))
    t = yield by_ticker(ts.rank(k, 3))
    x = yield by_date(rank(w))
    return smaller(x, t)


def f092(b):
    w, adv = yield by_ticker(ts.decay(flag(less((b.H + b.L) / 2 + b.C, b.L + b.O)), 15), ts.mean(b.V, 30))
    s = yield by_ticker(ts.rank(w, 19))
    x, y = yield by_date(rank(b.L), rank(adv))
    k = yield by_ticker(ts.corr(x, y, 8))
    k = yield by_ticker(ts.decay(k, 7))
    t = yield by_ticker(ts.rank(k, 7))
    return smaller(s, t)


def f094(b):
    lo, p, adv = yield by_ticker(ts.low(b.W, 12), ts.rank(b.W, 20), ts.mean(b.V, 60))
    q = yield by_ticker(ts.rank(adv, 4))
    k = yield by_ticker(ts.corr(p, q, 18))
    t = yield by_ticker(ts.rank(k, 3))
    x = yield by_date(rank(b.W - lo))
    return -power(x, t)


def f095(b):
    lo, m, adv = yield by_ticker(ts.low(b.O, 12), ts.total((b.H + b.L) / 2, 19), ts.mean(b.V, 40))
    s = yield by_ticker(ts.total(adv, 19))
    k = yield by_ticker(ts.corr(m, s, 13))
    x, y = yield by_date(rank(b.O - lo), rank(k))
    t = yield by_ticker(ts.rank(power(y, 5), 12))
    return pick(less(x, t), 1.0, 0.0)


def f096(b):
    x, y = yield by_date(rank(b.W), rank(b.V))
    k, c, adv = yield by_ticker(ts.corr(x, y, 4), ts.rank(b.C, 7), ts.mean(b.V, 60))
    k, adv = yield by_ticker(ts.decay(k, 4), ts.rank(adv, 4))
    s, m = yield by_ticker(ts.rank(k, 8), ts.corr(c, adv, 4))
    m = yield by_ticker(ts.argmax(m, 13))
    m = yield by_ticker(ts.decay(m, 14))
    t = yield by_ticker(ts.rank(m, 13))
    return -larger(s, t)


def f098(b):
    adv5, adv15 = yield by_ticker(ts.mean(b.V, 5), ts.mean(b.V, 15))
    s = yield by_ticker(ts.total(adv5, 26))
    k = yield by_ticker(ts.corr(b.W, s, 5))
    w = yield by_ticker(ts.decay(k, 7))
    x, p, q = yield by_date(rank(w), rank(b.O), rank(adv15))
    k = yield by_ticker(ts.corr(p, q, 21))
    m = yield by_ticker(ts.argmin(k, 9))
    m = yield by_ticker(ts.rank(m, 7))
    m = yield by_ticker(ts.decay(m, 8))
    y = yield by_date(rank(m))
    return x - y


def f099(b):
    m, adv, k2 = yield by_ticker(ts.total((b.H + b.L) / 2, 20), ts.mean(b.V, 60), ts.corr(b.L, b.V, 6))
    s = yield by_ticker(ts.total(adv, 20))
    k = yield by_ticker(ts.corr(m, s, 9))
    x, y = yield by_date(rank(k), rank(k2))
    return below(x, y)


def f101(b):
    return div(b.C - b.O, b.H - b.L + 0.001)


FACTORS = {name: fn for name, fn in sorted(globals().items())
           if name[0] == "f" and name[1:].isdigit()}
