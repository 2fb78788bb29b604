"""The implemented part of the "191 short-horizon alphas", for every (ticker, trade_date).

``rank`` is the percent rank of the day. A comparison that cannot be decided yet counts as false.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import ts
from ..functions.scalar import div, larger, less, ln, not_more, pick, power, sign, smaller
from .staging import by_date, by_ticker, rank


def location(b):
    """Where the close sits in the bar's range, -1 to 1."""
    return div((b.C - b.L) - (b.H - b.C), b.H - b.L)


def typical(b):
    return (b.H + b.L + b.C) / 3


def below(x, y, then=-1.0):
    return pick(less(x, y), then, 0.0)


# reusable steps: each is a generator that a factor delegates to

def rank_corr(x, y, n):
    p, q = yield by_date(rank(x), rank(y))
    return (yield by_ticker(ts.corr(p, q, n)))


def returns(b):
    return (yield by_ticker(ts.change(b.C, 1)))


def ranks(*xs_):
    return (yield by_date(*[rank(x) for x in xs_]))


def stochastic(b, n, top=False):
    """Position of the close within the n-row range, in percent, from the bottom or from the top."""
    hi, lo = yield by_ticker(ts.high(b.H, n), ts.low(b.L, n))
    return div(((hi - b.C) if top else (b.C - lo)) * 100, hi - lo)


def corr_of_sum(x, y, m, s, n):
    """corr(x, sum(mean(y, m), s), n)"""
    adv = yield by_ticker(ts.mean(y, m))
    total = yield by_ticker(ts.total(adv, s))
    return (yield by_ticker(ts.corr(x, total, n)))


def corr_of_mean(x, y, m, n):
    """corr(x, mean(y, m), n)"""
    adv = yield by_ticker(ts.mean(y, m))
    return (yield by_ticker(ts.corr(x, adv, n)))


def signed_volume(b, prev, n):
    return (yield by_ticker(ts.total(
        pick(less(prev, b.C), b.V, pick(less(b.C, prev), -b.V, 0.0)), n)))


def curve(b):
    c10, c20 = yield by_ticker(ts.delay(b.C, 10), ts.delay(b.C, 20))
    return (c20 - c10) / 10 - (c10 - b.C) / 10


def g001(b):
    d = yield by_ticker(ts.delta(b.V, 1))
    k = yield from rank_corr(d, div(b.C - b.O, b.O), 6)
    return -k


def g002(b):
    d = yield by_ticker(ts.delta(location(b), 1))
    return -d


def g003(b):
    c = yield by_ticker(ts.delay(b.C, 1))
    x = pick(b.C == c, 0.0, b.C - pick(less(c, b.C), smaller(b.L, c), larger(b.H, c)))
    return (yield by_ticker(ts.total(x, 6)))


def g004(b):
    m8, s8, m2, adv = yield by_ticker(ts.mean(b.C, 8), ts.std(b.C, 8), ts.mean(b.C, 2), ts.mean(b.V, 20))
    return pick(less(m8 + s8, m2), -1.0,
                pick(less(m2, m8 - s8), 1.0, pick(not_more(1.0, div(b.V, adv)), 1.0, -1.0)))


def g005(b):
    h, v = yield by_ticker(ts.rank(b.H, 7), ts.rank(b.V, 7))
    k = yield by_ticker(ts.corr(h, v, 5))
    return (yield by_ticker(ts.high(k, 3)))


def g006(b):
    d = yield by_ticker(ts.delta(b.O * 0.85 + b.H * 0.15, 4))
    return (yield from ranks(sign(d - 1)))


def g007(b):
    d = yield by_ticker(ts.delta(b.V, 3))
    x, y, z = yield from ranks(larger(b.W - b.C, 3.0), smaller(b.W - b.C, 3.0), d)
    return x + y * z


def g008(b):
    d = yield by_ticker(ts.delta((b.H + b.L) * 0.2 / 2 + b.W * 0.8, 4))
    return (yield from ranks(-d))


def g009(b):
    h, l = yield by_ticker(ts.delay(b.H, 1), ts.delay(b.L, 1))
    return (yield by_ticker(ts.ewm((b.H + b.L) * 0.5 - div((h + l) * 0.5 * (b.H - b.L), b.V), 2 / 7)))


def g010(b):
    r = yield from returns(b)
    s = yield by_ticker(ts.std(r, 20))
    x = pick(r < 0, s, 0.0) + pick(r < 0, 0.0, b.C)
    return (yield from ranks(larger(x * x, 5.0)))


def g011(b):
    return (yield by_ticker(ts.total(location(b) * b.V, 6)))


def g012(b):
    s = yield by_ticker(ts.total(b.W, 10))
    x, y = yield from ranks(b.O - s / 10, F.abs(b.C - b.W))
    return -x * y


def g013(b):
    return power(b.H - b.L, 0.5) - b.W


def g014(b):
    return (yield by_ticker(ts.delta(b.C, 5)))


def g015(b):
    c = yield by_ticker(ts.delay(b.C, 1))
    return div(b.O, c) - 1


def g016(b):
    k = yield from rank_corr(b.V, b.W, 5)
    m = yield by_ticker(ts.high(k, 5))
    return -m


def g017(b):
    hi, d = yield by_ticker(ts.high(b.W, 15), ts.delta(b.C, 5))
    x = yield from ranks(b.C - hi)
    return power(x, d)


def g018(b):
    c = yield by_ticker(ts.delay(b.C, 5))
    return div(b.C, c)


def g019(b):
    c = yield by_ticker(ts.delay(b.C, 5))
    return pick(less(b.C, c), div(b.C - c, c), pick(less(c, b.C), div(b.C - c, b.C), 0.0))


def g020(b):
    c = yield by_ticker(ts.delay(b.C, 6))
    return div((b.C - c) * 100, c)


def g021(b):
    m = yield by_ticker(ts.mean(b.C, 6))
    # 2.776: two-sided 5 % point of Student's t with 4 degrees of freedom
    return (yield by_ticker(ts.slope_of_index(m, 6, critical_t=2.776)))


def g022(b):
    m = yield by_ticker(ts.mean(b.C, 6))
    x = div(b.C - m, m)
    old = yield by_ticker(ts.delay(x, 3))
    return (yield by_ticker(ts.ewm(x - old, 1 / 12)))


def g023(b):
    c, s = yield by_ticker(ts.delay(b.C, 1), ts.std(b.C, 20))
    up, down = yield by_ticker(ts.ewm(pick(less(c, b.C), s, 0.0), 1 / 20),
                               ts.ewm(pick(not_more(b.C, c), s, 0.0), 1 / 20))
    return div(up * 100, up + down)


def g024(b):
    d = yield by_ticker(ts.delta(b.C, 5))
    return (yield by_ticker(ts.ewm(d, 1 / 5)))


def g025(b):
    d, adv, r = yield by_ticker(ts.delta(b.C, 7), ts.mean(b.V, 20), ts.change(b.C, 1))
    w, s = yield by_ticker(ts.decay(div(b.V, adv), 9), ts.total(r, 250))
    x, y = yield from ranks(d, s)
    return -x * (1 - w) * (1 + y)


def g026(b):
    m, c = yield by_ticker(ts.total(b.C, 7), ts.delay(b.C, 5))
    k = yield by_ticker(ts.corr(b.W, c, 230))
    return m / 7 - b.C + k


def g028(b):
    x = yield from stochastic(b, 9)
    e = yield by_ticker(ts.ewm(x, 1 / 3))
    ee = yield by_ticker(ts.ewm(e, 1 / 3))
    return 3 * e - 2 * ee


def g029(b):
    c = yield by_ticker(ts.delay(b.C, 6))
    return div((b.C - c) * b.V, c)


def g031(b):
    m = yield by_ticker(ts.mean(b.C, 12))
    return div((b.C - m) * 100, m)


def g032(b):
    k = yield from rank_corr(b.H, b.V, 3)
    z = yield from ranks(F.coalesce(k, F.lit(0.0)))
    s = yield by_ticker(ts.total(z, 3))
    return -s


def g033(b):
    lo, r, t = yield by_ticker(ts.low(b.L, 5), ts.change(b.C, 1), ts.rank_pct(b.V, 5))
    old, s240, s20 = yield by_ticker(ts.delay(lo, 5), ts.total(r, 240), ts.total(r, 20))
    z = yield from ranks((s240 - s20) / 220)
    return old - lo + z + t


def g034(b):
    m = yield by_ticker(ts.mean(b.C, 12))
    return div(m, b.C)


def g035(b):
    d, k = yield by_ticker(ts.delta(b.O, 1), ts.corr(b.O * 0.65 + b.O * 0.35, b.V, 17))
    d, k = yield by_ticker(ts.decay(d, 15), ts.decay(k, 7))
    x = yield from ranks(d)
    return smaller(x, -k)


def g036(b):
    k = yield from rank_corr(b.V, b.W, 6)
    s = yield by_ticker(ts.total(k, 2))
    return (yield from ranks(s))


def g037(b):
    r = yield from returns(b)
    o, s = yield by_ticker(ts.total(b.O, 5), ts.total(r, 5))
    old = yield by_ticker(ts.delay(o * s, 10))
    z = yield from ranks(o * s)
    return -z - old


def g038(b):
    m, d = yield by_ticker(ts.mean(b.H, 20), ts.delta(b.H, 2))
    return pick(less(m, b.H), -d, 0.0)


def g039(b):
    d = yield by_ticker(ts.delta(b.C, 2))
    k = yield from corr_of_sum(b.W * 0.3 + b.O * 0.7, b.V, 180, 37, 14)
    d, k = yield by_ticker(ts.decay(d, 8), ts.decay(k, 12))
    x = yield from ranks(d)
    return x + k


def g040(b):
    c = yield by_ticker(ts.delay(b.C, 1))
    up, down = yield by_ticker(ts.sum_if(less(c, b.C), b.V, 26), ts.sum_if(not_more(b.C, c), b.V, 26))
    return div(up * 100, down)


def g041(b):
    d = yield by_ticker(ts.delta(b.W, 3))
    z = yield from ranks(larger(d, 5.0))
    return -z


def g042(b):
    k, s = yield by_ticker(ts.corr(b.H, b.V, 10), ts.std(b.H, 10))
    z = yield from ranks(s)
    return -k * z


def g043(b):
    c = yield by_ticker(ts.delay(b.C, 1))
    return (yield from signed_volume(b, c, 6))


def g044(b):
    d = yield by_ticker(ts.delta(b.W, 3))
    k = yield from corr_of_mean(b.L, b.V, 10, 7)
    k, d = yield by_ticker(ts.decay(k, 6), ts.decay(d, 10))
    x, y = yield by_ticker(ts.rank_pct(k, 4), ts.rank_pct(d, 5))
    return x + y


def g045(b):
    d = yield by_ticker(ts.delta(b.C * 0.6 + b.O * 0.4, 1))
    k = yield from corr_of_mean(b.W, b.V, 150, 15)
    x, y = yield from ranks(d, k)
    return x * y


def _mean_of_means(b):
    m3, m6, m12, m24 = yield by_ticker(*[ts.mean(b.C, n) for n in (3, 6, 12, 24)])
    return (m3 + m6 + m12 + m24) / 4


def g046(b):
    m = yield from _mean_of_means(b)
    return div(m, b.C)


def g047(b):
    x = yield from stochastic(b, 6, top=True)
    return (yield by_ticker(ts.ewm(x, 1 / 9)))


def g048(b):
    c1, c2, c3, s5, s20 = yield by_ticker(ts.delay(b.C, 1), ts.delay(b.C, 2), ts.delay(b.C, 3),
                                          ts.total(b.V, 5), ts.total(b.V, 20))
    return div(-(sign(b.C - c1) + sign(c1 - c2) + sign(c2 - c3)) * s5, s20)


def g049(b):
    h, l = yield by_ticker(ts.delay(b.H, 1), ts.delay(b.L, 1))
    d = larger(F.abs(b.H - h), F.abs(b.L - l))
    down, up = yield by_ticker(ts.sum_if(less(b.H + b.L, h + l), d, 12), ts.sum_if(less(h + l, b.H + b.L), d, 12))
    return div(down, down + up)


def g052(b):
    t = yield by_ticker(ts.delay(typical(b), 1))
    x, y = yield by_ticker(ts.total(larger(b.H - t, 0.0), 26), ts.total(larger(t - b.L, 0.0), 26))
    return x + y


def _share_of_rises(b, n):
    c = yield by_ticker(ts.delay(b.C, 1))
    k = yield by_ticker(ts.count_if(less(c, b.C), n))
    return k * 100 / n


def g053(b):
    return (yield from _share_of_rises(b, 12))


def g054(b):
    s, k = yield by_ticker(ts.std(F.abs(b.C - b.O), 250), ts.corr(b.C, b.O, 10))
    return (yield from ranks(s + (b.C - b.O) + k))


def g056(b):
    lo, m = yield by_ticker(ts.low(b.O, 12), ts.total((b.H + b.L) / 2, 19))
    k = yield from corr_of_sum(m, b.V, 40, 19, 13)
    x, y = yield from ranks(b.O - lo, k)
    y = yield from ranks(power(y, 5))
    return below(x, y, 1.0)


def g057(b):
    x = yield from stochastic(b, 9)
    return (yield by_ticker(ts.ewm(x, 1 / 3)))


def g058(b):
    return (yield from _share_of_rises(b, 20))


def g059(b):
    c = yield by_ticker(ts.delay(b.C, 1))
    x = b.C - pick(less(c, b.C), smaller(b.L, c), 0.0) - pick(less(b.C, c), larger(b.H, c), 0.0)
    return (yield by_ticker(ts.total(x, 20)))


def g060(b):
    return (yield by_ticker(ts.total(b.V * location(b), 20)))


def g061(b):
    d = yield by_ticker(ts.delta(b.W, 1))
    k = yield from corr_of_mean(b.L, b.V, 80, 8)
    k = yield from ranks(k)
    d, k = yield by_ticker(ts.decay(d, 12), ts.decay(k, 17))
    x, y = yield from ranks(d, k)
    return larger(x, -y)


def g062(b):
    v = yield from ranks(b.V)
    k = yield by_ticker(ts.corr(b.H, v, 5))
    return -k


def _strength(b, up, both):
    up, both = yield by_ticker(up, both)
    return div(up * 100, both)


def g063(b):
    d = yield by_ticker(ts.delta(b.C, 1))
    return (yield from _strength(b, ts.ewm(larger(d, 0.0), 1 / 6), ts.ewm(F.abs(d), 1 / 6)))


def g064(b):
    adv = yield by_ticker(ts.mean(b.V, 60))
    w, v, c = yield from ranks(b.W, b.V, b.C)
    k1, k2 = yield by_ticker(ts.corr(w, v, 4), ts.corr(c, adv, 4))
    k1, k2 = yield by_ticker(ts.decay(k1, 4), ts.decay(larger(k2, 13.0), 14))
    x, y = yield from ranks(k1, k2)
    return larger(x, -y)


def g065(b):
    m = yield by_ticker(ts.mean(b.C, 6))
    return div(m, b.C)


def g066(b):
    m = yield by_ticker(ts.mean(b.C, 6))
    return div(b.C - m, m)


def g067(b):
    d = yield by_ticker(ts.delta(b.C, 1))
    return (yield from _strength(b, ts.ewm(larger(d, 0.0), 1 / 24), ts.ewm(F.abs(d), 1 / 24)))


def g068(b):
    h, l = yield by_ticker(ts.delay(b.H, 1), ts.delay(b.L, 1))
    return (yield by_ticker(ts.ewm(((b.H + b.L) / 2 - h + div(l * 0.5 * (b.H - b.L), b.V)) * 100, 2 / 15)))


def g070(b):
    return (yield by_ticker(ts.std(b.A, 6)))


def g071(b):
    m = yield by_ticker(ts.mean(b.C, 24))
    return div(b.C - m, m) * 100


def g072(b):
    x = yield from stochastic(b, 6, top=True)
    return (yield by_ticker(ts.ewm(x, 1 / 15)))


def g074(b):
    s, adv = yield by_ticker(ts.total(b.L * 0.35 + b.W * 0.65, 20), ts.mean(b.V, 40))
    k1 = yield by_ticker(ts.corr(s, adv, 7))
    k2 = yield from rank_corr(b.W, b.V, 6)
    x, y = yield from ranks(k1, k2)
    return x + y


def g075(b):
    falls = less(b.BC, b.BO)
    x, y = yield by_ticker(ts.count_if(less(b.O, b.C) & falls, 50), ts.count_if(falls, 50))
    return div(x, y)


def g076(b):
    r = yield from returns(b)
    x = div(F.abs(r), b.V)
    s, m = yield by_ticker(ts.std(x, 20), ts.mean(x, 20))
    return div(s, m)


def g077(b):
    w = yield by_ticker(ts.decay((b.H + b.L) / 2 + b.H - (b.W + b.H), 20))
    k = yield from corr_of_mean((b.H + b.L) / 2, b.V, 40, 3)
    k = yield by_ticker(ts.decay(k, 6))
    x, y = yield from ranks(w, k)
    return smaller(x, y)


def g078(b):
    m = yield by_ticker(ts.mean(typical(b), 12))
    d = yield by_ticker(ts.mean(F.abs(b.C - m), 12))
    return div(typical(b) - m, 0.015 * d)


def g079(b):
    d = b.C - b.P
    return (yield from _strength(b, ts.ewm(larger(d, 0.0), 1 / 12), ts.ewm(F.abs(d), 1 / 12)))


def g080(b):
    v = yield by_ticker(ts.delay(b.V, 5))
    return div(b.V - v, v) * 100


def g081(b):
    return (yield by_ticker(ts.ewm(b.V, 2 / 21)))


def g082(b):
    x = yield from stochastic(b, 6, top=True)
    return (yield by_ticker(ts.ewm(x, 1 / 20)))


def g083(b):
    h, v = yield by_ticker(ts.rank_pct(b.H, 250), ts.rank_pct(b.V, 250))
    k = yield by_ticker(ts.corr(h, v, 5))
    return -k


def g084(b):
    c = yield by_ticker(ts.delay(b.C, 1))
    return (yield from signed_volume(b, c, 20))


def g085(b):
    adv, d = yield by_ticker(ts.mean(b.V, 20), ts.delta(b.C, 7))
    x, y = yield by_ticker(ts.rank_pct(div(b.V, adv), 20), ts.rank_pct(-d, 8))
    return x * y


def g086(b):
    d = yield by_ticker(ts.delta(b.C, 1))
    x = yield from curve(b)
    return pick(less(0.25, x), -1.0, pick(less(x, 0.0), 1.0, -d))


def g087(b):
    d, w = yield by_ticker(ts.delta(b.W, 4), ts.decay(div(b.L - b.W, b.O - 0.5 * (b.H + b.L)), 11))
    d, t = yield by_ticker(ts.decay(d, 7), ts.rank_pct(-w, 7))
    x = yield from ranks(d)
    return x + t


def g088(b):
    c = yield by_ticker(ts.delay(b.C, 20))
    return div(b.C - c, c) * 100


def _macd(x):
    fast, slow = yield by_ticker(ts.ewm_recursive(x, span=12), ts.ewm_recursive(x, span=26))
    signal = yield by_ticker(ts.ewm_recursive(fast - slow, span=9))
    return fast - slow - signal


def g089(b):
    x = yield from _macd(b.C)
    return 2 * x


def g090(b):
    k = yield from rank_corr(b.W, b.V, 5)
    z = yield from ranks(k)
    return -z


def g091(b):
    k = yield from corr_of_mean(b.L, b.V, 40, 5)
    x, y = yield from ranks(b.C - larger(b.C, 5.0), k)
    return -x * y


def g092(b):
    d = yield by_ticker(ts.delta(b.C * 0.35 + b.W * 0.65, 2))
    k = yield from corr_of_mean(b.C, b.V, 180, 13)
    d, k = yield by_ticker(ts.decay(d, 3), ts.decay(F.abs(k), 5))
    t = yield by_ticker(ts.rank_of_top(k, 15))
    x = yield from ranks(d)
    return -larger(x, t)


def g093(b):
    o = yield by_ticker(ts.delay(b.O, 1))
    return (yield by_ticker(ts.total(pick(not_more(o, b.O), 0.0, larger(b.O - b.L, b.O - o)), 20)))


def g094(b):
    return (yield from signed_volume(b, b.P, 30))


def g095(b):
    return (yield by_ticker(ts.std(b.A, 20)))


def g096(b):
    x = yield from stochastic(b, 9)
    e = yield by_ticker(ts.ewm_recursive(x, span=5))
    return (yield by_ticker(ts.ewm_recursive(e, span=5)))


def g097(b):
    return (yield by_ticker(ts.std(b.V, 10)))


def g098(b):
    m, c, lo, d = yield by_ticker(ts.mean(b.C, 100), ts.delay(b.C, 100), ts.low(b.C, 100), ts.delta(b.C, 3))
    old = yield by_ticker(ts.delay(m, 100))
    return pick(not_more(div(m - old, c), 0.05), lo - b.C, -d)


def g099(b):
    x, y = yield from ranks(b.C, b.V)
    k = yield by_ticker(ts.cov(x, y, 5))
    z = yield from ranks(k)
    return -z


def g100(b):
    return (yield by_ticker(ts.std(b.V, 20)))


def g101(b):
    k1 = yield from corr_of_sum(b.C, b.V, 30, 37, 15)
    k2 = yield from rank_corr(b.H * 0.1 + b.W * 0.9, b.V, 11)
    x, y = yield from ranks(k1, k2)
    return below(x, y)


def g102(b):
    d = yield by_ticker(ts.delta(b.V, 1))
    return (yield from _strength(b, ts.ewm_recursive(larger(d, 0.0), span=11), ts.ewm_recursive(F.abs(d), span=11)))


def g103(b):
    d = yield by_ticker(ts.lowday(b.L, 20))
    return (20 - d) / 20 * 100


def g104(b):
    k, s = yield by_ticker(ts.corr(b.H, b.V, 5), ts.std(b.C, 20))
    d = yield by_ticker(ts.delta(k, 5))
    z = yield from ranks(s)
    return -d * z


def g105(b):
    k = yield from rank_corr(b.O, b.V, 10)
    return -k


def g106(b):
    return (yield by_ticker(ts.delta(b.C, 20)))


def g107(b):
    h, c, l = yield by_ticker(ts.delay(b.H, 1), ts.delay(b.C, 1), ts.delay(b.L, 1))
    x, y, z = yield from ranks(b.O - h, b.O - c, b.O - l)
    return -x * y * z


def g108(b):
    k = yield from corr_of_mean(b.W, b.V, 120, 6)
    x, y = yield from ranks(b.H - smaller(b.H, 2.0), k)
    return -power(x, y)


def g109(b):
    e = yield by_ticker(ts.ewm_recursive(b.H - b.L, span=9))
    ee = yield by_ticker(ts.ewm_recursive(e, span=9))
    return div(e, ee)


def g110(b):
    x, y = yield by_ticker(ts.total(larger(b.H - b.P, 0.0), 20), ts.total(larger(b.P - b.L, 0.0), 20))
    return div(x, y) * 100


def g111(b):
    x = b.V * location(b)
    e10, e3 = yield by_ticker(ts.ewm(x, span=10), ts.ewm(x, span=3))
    return e10 - e3


def g112(b):
    up, down = yield by_ticker(ts.total(larger(b.C - b.P, 0.0), 12), ts.total(larger(b.P - b.C, 0.0), 12))
    return div(up - down, up + down) * 100


def g113(b):
    c, k, s5, s20 = yield by_ticker(ts.delay(b.C, 5), ts.corr(b.C, b.V, 2), ts.total(b.C, 5), ts.total(b.C, 20))
    m, k2 = yield by_ticker(ts.total(c, 20), ts.corr(s5, s20, 2))
    x, y = yield from ranks(m / 20, k2)
    return -x * k * y


def g114(b):
    m = yield by_ticker(ts.mean(b.C, 5))
    spread = div(b.H - b.L, m)
    old = yield by_ticker(ts.delay(spread, 2))
    x, y = yield from ranks(old, b.V)
    y = yield from ranks(y)
    return div(x * y, div(spread, b.W - b.C))


def g115(b):
    adv, m, v = yield by_ticker(ts.mean(b.V, 30), ts.rank_of_top((b.H + b.L) / 2, 4), ts.rank_of_top(b.V, 10))
    k1, k2 = yield by_ticker(ts.corr(b.H * 0.9 + b.C * 0.1, adv, 10), ts.corr(m, v, 7))
    x, y = yield from ranks(k1, k2)
    return power(x, y)


def g116(b):
    return (yield by_ticker(ts.slope(b.C, 20)))


def g117(b):
    r, v, x = yield by_ticker(ts.change(b.C, 1), ts.rank_pct(b.V, 32), ts.rank_pct(b.C + b.H - b.L, 16))
    t = yield by_ticker(ts.rank_pct(r, 32))
    return v * (1 - x) * (1 - t)


def g118(b):
    x, y = yield by_ticker(ts.total(b.H - b.O, 20), ts.total(b.O - b.L, 20))
    return div(x, y) * 100


def g119(b):
    adv = yield by_ticker(ts.mean(b.V, 15))
    k1 = yield from corr_of_sum(b.W, b.V, 5, 26, 5)
    w = yield by_ticker(ts.decay(k1, 7))
    k2 = yield from rank_corr(b.O, adv, 21)
    m = yield by_ticker(ts.low(k2, 9))
    t = yield by_ticker(ts.rank_of_top(m, 7))
    t = yield by_ticker(ts.decay(t, 8))
    x, y = yield from ranks(w, t)
    return x - y


def g120(b):
    x, y = yield from ranks(b.W - b.C, b.W + b.C)
    return div(x, y)


def _triple(x, step):
    x = yield by_ticker(step(x, span=12))
    x = yield by_ticker(step(x, span=12))
    return (yield by_ticker(step(x, span=12)))


def g122(b):
    t = yield from _triple(ln(b.C), ts.ewm_recursive)
    return (yield by_ticker(ts.change(t, 1)))


def g123(b):
    m, k2 = yield by_ticker(ts.total((b.H + b.L) / 2, 20), ts.corr(b.L, b.V, 6))
    k1 = yield from corr_of_sum(m, b.V, 60, 20, 9)
    x, y = yield from ranks(k1, k2)
    return below(x, y)


def g124(b):
    hi = yield by_ticker(ts.high(b.C, 30))
    z = yield from ranks(hi)
    old = yield by_ticker(ts.delay(z, 1))
    return div(b.C - b.W, old * 2 / 3 + z / 3)


def g125(b):
    d = yield by_ticker(ts.delta(b.C * 0.5 + b.W * 0.5, 3))
    k = yield from corr_of_mean(b.W, b.V, 80, 17)
    k, d = yield by_ticker(ts.decay(k, 20), ts.decay(d, 16))
    x, y = yield from ranks(k, d)
    return div(x, y)


def g126(b):
    return typical(b)


def g129(b):
    d = yield by_ticker(ts.delta(b.C, 1))
    return (yield by_ticker(ts.total(F.abs(smaller(d, 0.0)), 12)))


def g130(b):
    k1 = yield from corr_of_mean((b.H + b.L) / 2, b.V, 40, 9)
    k2 = yield from rank_corr(b.W, b.V, 7)
    k1, k2 = yield by_ticker(ts.decay(k1, 10), ts.decay(k2, 3))
    x, y = yield from ranks(k1, k2)
    return div(x, y)


def g132(b):
    return (yield by_ticker(ts.mean(b.A, 20)))


def g133(b):
    h, l = yield by_ticker(ts.highday(b.H, 20), ts.lowday(b.L, 20))
    return (20 - h) / 20 * 100 - (20 - l) / 20 * 100


def g134(b):
    r = yield by_ticker(ts.change(b.C, 12))
    return r * b.V


def g135(b):
    c = yield by_ticker(ts.delay(b.C, 20))
    x = yield by_ticker(ts.delay(div(b.C, c), 1))
    return (yield by_ticker(ts.ewm_recursive(x, 1 / 20)))


def g136(b):
    r, k = yield by_ticker(ts.change(b.C, 1), ts.corr(b.O, b.V, 10))
    d = yield by_ticker(ts.delta(r, 3))
    z = yield from ranks(d)
    return -z * k


def g138(b):
    l, adv, d = yield by_ticker(ts.rank_of_top(b.L, 8), ts.mean(b.V, 60), ts.delta(b.L * 0.7 + b.W * 0.3, 3))
    v, d = yield by_ticker(ts.rank_of_top(adv, 17), ts.decay(d, 20))
    k = yield by_ticker(ts.corr(l, v, 5))
    k = yield by_ticker(ts.rank_of_top(k, 19))
    k = yield by_ticker(ts.decay(k, 16))
    t = yield by_ticker(ts.rank_pct(k, 7))
    x = yield from ranks(d)
    return t - x


def g139(b):
    k = yield by_ticker(ts.corr(b.O, b.V, 10))
    return -k


def g140(b):
    o, l, h, c = yield from ranks(b.O, b.L, b.H, b.C)
    w, p, adv = yield by_ticker(ts.decay(o + l - h - c, 8), ts.rank_of_top(b.C, 8), ts.mean(b.V, 60))
    q = yield by_ticker(ts.rank_of_top(adv, 20))
    k = yield by_ticker(ts.corr(p, q, 8))
    k = yield by_ticker(ts.decay(k, 7))
    t = yield by_ticker(ts.rank_pct(k, 3))
    x = yield from ranks(w)
    return smaller(x, t)


def g141(b):
    adv = yield by_ticker(ts.mean(b.V, 15))
    k = yield from rank_corr(b.H, adv, 9)
    z = yield from ranks(k)
    return -z


def g142(b):
    t, d, adv = yield by_ticker(ts.rank_pct(b.C, 10), ts.delta(b.C, 1), ts.mean(b.V, 20))
    dd, v = yield by_ticker(ts.delta(d, 1), ts.rank_pct(div(b.V, adv), 5))
    x, y, z = yield from ranks(t, dd, v)
    return -x * y * z


def g144(b):
    falls = less(b.C, b.P)
    s, n = yield by_ticker(ts.sum_if(falls, div(F.abs(div(b.C, b.P) - 1), b.A), 20), ts.count_if(falls, 20))
    return div(s, n)


def g145(b):
    m9, m26, m12 = yield by_ticker(ts.mean(b.V, 9), ts.mean(b.V, 26), ts.mean(b.V, 12))
    return div(m9 - m26, m12) * 100


def g148(b):
    lo = yield by_ticker(ts.low(b.O, 14))
    k = yield from corr_of_sum(b.O, b.V, 60, 9, 6)
    x, y = yield from ranks(k, b.O - lo)
    return below(x, y)


def g150(b):
    return typical(b) * b.V


def g152(b):
    c = yield by_ticker(ts.delay(b.C, 9))
    x = yield by_ticker(ts.delay(div(b.C, c), 1))
    x = yield by_ticker(ts.ewm_recursive(x, span=17))
    y = yield by_ticker(ts.delay(x, 1))
    m12, m26 = yield by_ticker(ts.mean(y, 12), ts.mean(y, 26))
    return (yield by_ticker(ts.ewm_recursive(m12 - m26, span=17)))


def g153(b):
    return (yield from _mean_of_means(b))


def g154(b):
    lo = yield by_ticker(ts.low(b.W, 16))
    k = yield from corr_of_mean(b.W, b.V, 180, 18)
    return below(b.W - lo, k, 1.0)


def g155(b):
    return (yield from _macd(b.V))


def g156(b):
    m = b.O * 0.15 + b.L * 0.85
    d, e = yield by_ticker(ts.delta(b.W, 5), ts.delta(m, 2))
    d, e = yield by_ticker(ts.decay(d, 3), ts.decay(-div(e, m), 3))
    x, y = yield from ranks(d, e)
    return -larger(x, y)


def g157(b):
    d, old = yield by_ticker(ts.delta(b.C - 1, 5), ts.delay(1 - div(b.C, b.P), 6))
    x = yield from ranks(d)
    x = yield from ranks(-x)
    x = yield from ranks(x)
    lo, t = yield by_ticker(ts.low(x, 2), ts.rank_of_top(old, 5))
    x = yield from ranks(ln(lo))
    x = yield from ranks(x)
    return smaller(x, 5.0) + t


def g158(b):
    e = yield by_ticker(ts.ewm_recursive(b.C, span=14))
    return div((b.H - e) - (b.L - e), b.C)


def g159(b):
    c = yield by_ticker(ts.delay(b.C, 1))
    lo, hi = smaller(b.L, c), larger(b.H, c)
    sums = yield by_ticker(*[ts.total(x, n) for n in (6, 12, 24) for x in (lo, hi - lo)])
    parts = [div(b.C - sums[2 * i], sums[2 * i + 1]) for i in range(3)]
    return (parts[0] * 12 * 24 + parts[1] * 6 * 24 + parts[2] * 6 * 24) * 100 / (6 * 12 + 12 * 24 + 6 * 24)


def g160(b):
    c, s = yield by_ticker(ts.delay(b.C, 1), ts.std(b.C, 20))
    return (yield by_ticker(ts.ewm(pick(not_more(b.C, c), s, 0.0), span=39)))


def _mean_true_range(b, n):
    t = yield by_ticker(ts.true_range(b.H, b.L, b.C))
    return (yield by_ticker(ts.mean(t, n)))


def g161(b):
    return (yield from _mean_true_range(b, 12))


def g162(b):
    d = yield by_ticker(ts.delta(b.C, 1))
    s = yield from _strength(b, ts.ewm(larger(d, 0.0), span=23), ts.ewm(F.abs(d), span=23))
    return div(s - smaller(s, 12.0), larger(s, 12.0) - smaller(s, 12.0))


def g163(b):
    r, adv = yield by_ticker(ts.change(b.C, 1), ts.mean(b.V, 20))
    return (yield from ranks(-r * adv * b.W * (b.H - b.C)))


def g164(b):
    c = yield by_ticker(ts.delay(b.C, 1))
    d = pick(less(c, b.C), div(1.0, b.C - c), 1.0)
    return (yield by_ticker(ts.ewm(div(d - smaller(d, 12.0), b.H - b.L) * 100, span=12)))


def g167(b):
    d = yield by_ticker(ts.delta(b.C, 1))
    return (yield by_ticker(ts.total(larger(d, 0.0), 12)))


def g168(b):
    m = yield by_ticker(ts.mean(b.V, 20))
    return -div(b.V, m)


def g169(b):
    d = yield by_ticker(ts.delta(b.C, 1))
    e = yield by_ticker(ts.ewm(d, span=17))
    y = yield by_ticker(ts.delay(e, 1))
    m12, m26 = yield by_ticker(ts.mean(y, 12), ts.mean(y, 26))
    return (yield by_ticker(ts.ewm(m12 - m26, span=19)))


def g170(b):
    adv, m, w = yield by_ticker(ts.mean(b.V, 20), ts.mean(b.H, 5), ts.delay(b.W, 4))
    x, y, z = yield from ranks(div(1.0, b.C), b.H - b.C, b.W - w)
    return div(x * b.V, adv) * div(y * b.H, m) - z


def g171(b):
    return div(-(b.L - b.C) * power(b.O, 5), (b.C - b.H) * power(b.C, 5))


def _directional(b):
    h, l, t = yield by_ticker(ts.delay(b.H, 1), ts.delay(b.L, 1), ts.true_range(b.H, b.L, b.C))
    up, down = b.H - h, l - b.L
    s1, s2, s = yield by_ticker(
        ts.sum_if((down > 0) & less(up, down), down, 14),
        ts.sum_if((up > 0) & less(down, up), up, 14),
        ts.total(t, 14))
    s1, s2 = div(s1 * 100, s), div(s2 * 100, s)
    return (yield by_ticker(ts.mean(div(F.abs(s1 - s2), s1 + s2) * 100, 6)))


def g172(b):
    return (yield from _directional(b))


def g173(b):
    e = yield by_ticker(ts.ewm(b.C, span=12))
    ee = yield by_ticker(ts.ewm(e, span=12))
    t = yield from _triple(ln(b.C), ts.ewm)
    return 3 * e - 2 * ee + t


def g174(b):
    s = yield by_ticker(ts.std(b.C, 20))
    return (yield by_ticker(ts.ewm_recursive(pick(less(b.P, b.C), s, 0.0), span=39)))


def g175(b):
    return (yield from _mean_true_range(b, 6))


def g176(b):
    x = yield from stochastic(b, 12)
    x, v = yield by_ticker(ts.rank_pct(x / 100, 250), ts.rank_pct(b.V, 250))
    return (yield by_ticker(ts.corr(x, v, 6)))


def g177(b):
    d = yield by_ticker(ts.highday(b.H, 20))
    return (20 - d) / 20 * 100


def g178(b):
    r = yield from returns(b)
    return r * b.V


def g179(b):
    k, l, adv = yield by_ticker(ts.corr(b.W, b.V, 4), ts.rank_pct(b.L, 250), ts.mean(b.V, 50))
    v = yield by_ticker(ts.rank_pct(adv, 250))
    k2 = yield by_ticker(ts.corr(l, v, 12))
    x, y = yield from ranks(k, k2)
    return x * y


def g180(b):
    adv, d = yield by_ticker(ts.mean(b.V, 20), ts.delta(b.C, 7))
    t = yield by_ticker(ts.rank_pct(F.abs(d), 60))
    return pick(less(adv, b.V), -t * sign(d), -b.V)


def g182(b):
    with_index = (less(b.O, b.C) & less(b.BC, b.BO)) | (less(b.C, b.O) & less(b.BO, b.BC))
    n = yield by_ticker(ts.count_if(with_index, 20))
    return n / 20


def g184(b):
    old = yield by_ticker(ts.delay(b.O - b.C, 1))
    k = yield by_ticker(ts.corr(old, b.C, 200))
    x, y = yield from ranks(b.O - b.C, k)
    return x + y


def g185(b):
    x = 1 - div(b.O, b.C)
    return (yield from ranks(-(x * x)))


def g186(b):
    x = yield from _directional(b)
    old = yield by_ticker(ts.delay(x, 6))
    return (x + old) / 2


def g187(b):
    o = yield by_ticker(ts.delay(b.O, 1))
    return (yield by_ticker(ts.total(pick(not_more(b.O, o), 0.0, larger(b.H - b.L, b.O - o)), 20)))


def g188(b):
    e = yield by_ticker(ts.ewm_recursive(b.H - b.L, span=10))
    return div(b.H - b.L - e, e) * 100


def g189(b):
    m = yield by_ticker(ts.mean(b.C, 6))
    return (yield by_ticker(ts.mean(F.abs(b.C - m), 6)))


def g191(b):
    k = yield from corr_of_mean(b.L, b.V, 20, 5)
    return k + (b.H + b.L) / 2 - b.C


FACTORS = {name: fn for name, fn in sorted(globals().items())
           if name[0] == "g" and name[1:].isdigit()}
