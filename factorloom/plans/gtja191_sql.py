"""The same 169 factors as nested formulas for the SQL check."""

from __future__ import annotations

from .sql import (absolute, argmax, big, corr, count, cov, decay, delay, delta, ewm, ewmn, highday, log, lowday, mean,
                  power, prod, rank, regbeta, regbeta_index, sign, small, ssum, std, sumif, tsmax, tsmin, tsrank_pct,
                  tsrank_top, where, zero_for_null)


def d1(b): return delay(b.C, 1)
def mid(b): return (b.H + b.L) / 2
def tp(b): return (b.C + b.H + b.L) / 3
def clv(b): return ((b.C - b.L) - (b.H - b.C)) / (b.H - b.L)
def spread(b): return (b.H - b.L) / mean(b.C, 5)
def rsv(b, n): return 100 * (b.C - tsmin(b.L, n)) / (tsmax(b.H, n) - tsmin(b.L, n))
def wr(b, n): return 100 * (tsmax(b.H, n) - b.C) / (tsmax(b.H, n) - tsmin(b.L, n))
def obv(b, p, n): return ssum(where(b.C > p, b.V, where(b.C < p, -b.V, 0)), n)
def tr(b): return big(big(b.H - b.L, absolute(d1(b) - b.H)), absolute(d1(b) - b.L))
def sq(x): return x * x


def bent(b):
    return (delay(b.C, 20) - delay(b.C, 10)) / 10 - (delay(b.C, 10) - b.C) / 10


def g003(b):
    p = d1(b)
    return ssum(where(b.C.same(p), 0, b.C - where(b.C > p, small(b.L, p), big(b.H, p))), 6)


def g004(b):
    m, s, m2 = mean(b.C, 8), std(b.C, 8), mean(b.C, 2)
    return where(m + s < m2, -1, where(m2 < m - s, 1, where(b.V / mean(b.V, 20) >= 1, 1, -1)))


def g010(b):
    return rank(big(sq(where(b.R < 0, std(b.R, 20), 0) + where(b.R < 0, 0, b.C)), 5))


def g019(b):
    p = delay(b.C, 5)
    return where(b.C < p, (b.C - p) / p, where(b.C > p, (b.C - p) / b.C, 0))


def g022(b):
    x = (b.C - mean(b.C, 6)) / mean(b.C, 6)
    return ewm(x - delay(x, 3), 1 / 12)


def g023(b):
    s = std(b.C, 20)
    up, down = ewm(where(b.C > d1(b), s, 0), 1 / 20), ewm(where(b.C <= d1(b), s, 0), 1 / 20)
    return up * 100 / (up + down)


def g028(b):
    e = ewm(rsv(b, 9), 1 / 3)
    return 3 * e - 2 * ewm(e, 1 / 3)


def g037(b):
    x = ssum(b.O, 5) * ssum(b.R, 5)
    return -rank(x) - delay(x, 10)


def g049(b):
    d = big(absolute(b.H - delay(b.H, 1)), absolute(b.L - delay(b.L, 1)))
    now, old = b.H + b.L, delay(b.H, 1) + delay(b.L, 1)
    s1, s2 = ssum(where(now < old, d, 0), 12), ssum(where(now > old, d, 0), 12)
    return s1 / (s1 + s2)


def g059(b):
    p = d1(b)
    return ssum(b.C - where(b.C > p, small(b.L, p), 0) - where(b.C < p, big(b.H, p), 0), 20)


def macd(x):
    d = ewmn(x, span=12) - ewmn(x, span=26)
    return d - ewmn(d, span=9)


def g109(b):
    e = ewmn(b.H - b.L, span=9)
    return e / ewmn(e, span=9)


def g112(b):
    u, d = ssum(big(b.C - b.P, 0), 12), ssum(big(b.P - b.C, 0), 12)
    return (u - d) / (u + d) * 100


def g122(b):
    t = ewmn(ewmn(ewmn(log(b.C), span=12), span=12), span=12)
    return t / delay(t, 1) - 1


def g124(b):
    z = rank(tsmax(b.C, 30))
    return (b.C - b.W) / (delay(z, 1) * 2 / 3 + z / 3)


def g152(b):
    y = delay(ewmn(delay(b.C / delay(b.C, 9), 1), span=17), 1)
    return ewmn(mean(y, 12) - mean(y, 26), span=17)


def g156(b):
    m = b.O * 0.15 + b.L * 0.85
    return -big(rank(decay(delta(b.W, 5), 3)), rank(decay(-(delta(m, 2) / m), 3)))


def g159(b):
    lo, hi = small(b.L, d1(b)), big(b.H, d1(b))

    def part(n):
        return (b.C - ssum(lo, n)) / ssum(hi - lo, n)
    return (part(6) * 288 + part(12) * 144 + part(24) * 144) * (100 / 504)


def g162(b):
    s = ewm(big(delta(b.C, 1), 0), span=23) / ewm(absolute(delta(b.C, 1)), span=23) * 100
    return (s - small(s, 12)) / (big(s, 12) - small(s, 12))


def g164(b):
    d = where(b.C > d1(b), 1 / delta(b.C, 1), 1)
    return ewm((d - small(d, 12)) / (b.H - b.L) * 100, span=12)


def g169(b):
    y = delay(ewm(delta(b.C, 1), span=17), 1)
    return ewm(mean(y, 12) - mean(y, 26), span=19)


def adx(b):
    hd, ld = b.H - delay(b.H, 1), delay(b.L, 1) - b.L
    s = ssum(tr(b), 14)
    s1 = ssum(where((ld > 0) & (ld > hd), ld, 0), 14) * 100 / s
    s2 = ssum(where((hd > 0) & (hd > ld), hd, 0), 14) * 100 / s
    return mean(absolute(s1 - s2) / (s1 + s2) * 100, 6)


def g173(b):
    def e(x):
        return ewm(x, span=12)
    return 3 * e(b.C) - 2 * e(e(b.C)) + e(e(e(log(b.C))))


FORMULAS = {
    "g001": lambda b: -corr(rank(delta(b.V, 1)), rank((b.C - b.O) / b.O), 6),
    "g002": lambda b: -delta(clv(b), 1),
    "g003": g003,
    "g004": g004,
    "g005": lambda b: tsmax(corr(tsrank_pct(b.H, 7), tsrank_pct(b.V, 7), 5), 3),
    "g006": lambda b: rank(sign(delta(b.O * 0.85 + b.H * 0.15, 4) - 1)),
    "g007": lambda b: rank(big(b.W - b.C, 3)) + rank(small(b.W - b.C, 3)) * rank(delta(b.V, 3)),
    "g008": lambda b: rank(-delta((b.H + b.L) * 0.2 / 2 + b.W * 0.8, 4)),
    "g009": lambda b: ewm((b.H + b.L) * 0.5 - (delay(b.H, 1) + delay(b.L, 1)) * 0.5 * (b.H - b.L) / b.V, 2 / 7),
    "g010": g010,
    "g011": lambda b: ssum(clv(b) * b.V, 6),
    "g012": lambda b: -rank(b.O - ssum(b.W, 10) / 10) * rank(absolute(b.C - b.W)),
    "g013": lambda b: power(b.H - b.L, 0.5) - b.W,
    "g014": lambda b: b.C - delay(b.C, 5),
    "g015": lambda b: b.O / delay(b.C, 1) - 1,
    "g016": lambda b: -tsmax(corr(rank(b.V), rank(b.W), 5), 5),
    "g017": lambda b: power(rank(b.C - tsmax(b.W, 15)), delta(b.C, 5)),
    "g018": lambda b: b.C / delay(b.C, 5),
    "g019": g019,
    "g020": lambda b: (b.C - delay(b.C, 6)) * 100 / delay(b.C, 6),
    "g021": lambda b: regbeta_index(mean(b.C, 6), 6, 2.776),
    "g022": g022,
    "g023": g023,
    "g024": lambda b: ewm(b.C - delay(b.C, 5), 1 / 5),
    "g025": lambda b: (-rank(delta(b.C, 7)) * (1 - decay(b.V / mean(b.V, 20), 9)) * (1 + rank(ssum(b.R, 250)))),
    "g026": lambda b: ssum(b.C, 7) / 7 - b.C + corr(b.W, delay(b.C, 5), 230),
    "g028": g028,
    "g029": lambda b: (b.C - delay(b.C, 6)) * b.V / delay(b.C, 6),
    "g031": lambda b: (b.C - mean(b.C, 12)) * 100 / mean(b.C, 12),
    "g032": lambda b: -ssum(rank(zero_for_null(corr(rank(b.H), rank(b.V), 3))), 3),
    "g033": lambda b: (delay(tsmin(b.L, 5), 5) - tsmin(b.L, 5) + rank((ssum(b.R, 240) - ssum(b.R, 20)) / 220)
                       + tsrank_pct(b.V, 5)),
    "g034": lambda b: mean(b.C, 12) / b.C,
    "g035": lambda b: small(rank(decay(delta(b.O, 1), 15)), -decay(corr(b.O * 0.65 + b.O * 0.35, b.V, 17), 7)),
    "g036": lambda b: rank(ssum(corr(rank(b.V), rank(b.W), 6), 2)),
    "g037": g037,
    "g038": lambda b: where(mean(b.H, 20) < b.H, -delta(b.H, 2), 0),
    "g039": lambda b: (rank(decay(delta(b.C, 2), 8))
                       + decay(corr(0.3 * b.W + 0.7 * b.O, ssum(mean(b.V, 180), 37), 14), 12)),
    "g040": lambda b: (100 * ssum(where(b.C > d1(b), b.V, 0), 26) / ssum(where(b.C <= d1(b), b.V, 0), 26)),
    "g041": lambda b: -rank(big(delta(b.W, 3), 5)),
    "g042": lambda b: -corr(b.H, b.V, 10) * rank(std(b.H, 10)),
    "g043": lambda b: obv(b, d1(b), 6),
    "g044": lambda b: (tsrank_pct(decay(corr(b.L, mean(b.V, 10), 7), 6), 4)
                       + tsrank_pct(decay(delta(b.W, 3), 10), 5)),
    "g045": lambda b: rank(delta(b.C * 0.6 + b.O * 0.4, 1)) * rank(corr(b.W, mean(b.V, 150), 15)),
    "g046": lambda b: (mean(b.C, 3) + mean(b.C, 6) + mean(b.C, 12) + mean(b.C, 24)) * 0.25 / b.C,
    "g047": lambda b: ewm(wr(b, 6), 1 / 9),
    "g048": lambda b: (-(sign(b.C - d1(b)) + sign(d1(b) - delay(b.C, 2)) + sign(delay(b.C, 2) - delay(b.C, 3)))
                       * ssum(b.V, 5) / ssum(b.V, 20)),
    "g049": g049,
    "g052": lambda b: ssum(big(b.H - delay(tp(b), 1), 0), 26) + ssum(big(delay(tp(b), 1) - b.L, 0), 26),
    "g053": lambda b: count(b.C > d1(b), 12) * 100 / 12,
    "g054": lambda b: rank(std(absolute(b.C - b.O), 250) + (b.C - b.O) + corr(b.C, b.O, 10)),
    "g056": lambda b: where(rank(b.O - tsmin(b.O, 12)) < rank(power(rank(
        corr(ssum(mid(b), 19), ssum(mean(b.V, 40), 19), 13)), 5)), 1, 0),
    "g057": lambda b: ewm(rsv(b, 9), 1 / 3),
    "g058": lambda b: count(b.C > d1(b), 20) * 100 / 20,
    "g059": g059,
    "g060": lambda b: ssum(b.V * clv(b), 20),
    "g061": lambda b: big(rank(decay(delta(b.W, 1), 12)), -rank(decay(rank(corr(b.L, mean(b.V, 80), 8)), 17))),
    "g062": lambda b: -corr(b.H, rank(b.V), 5),
    "g063": lambda b: ewm(big(b.C - d1(b), 0), 1 / 6) * 100 / ewm(absolute(b.C - d1(b)), 1 / 6),
    "g064": lambda b: big(rank(decay(corr(rank(b.W), rank(b.V), 4), 4)),
                          -rank(decay(big(corr(rank(b.C), mean(b.V, 60), 4), 13), 14))),
    "g065": lambda b: mean(b.C, 6) / b.C,
    "g066": lambda b: (b.C - mean(b.C, 6)) / mean(b.C, 6),
    "g067": lambda b: ewm(big(delta(b.C, 1), 0), 1 / 24) * 100 / ewm(absolute(delta(b.C, 1)), 1 / 24),
    "g068": lambda b: ewm((mid(b) - delay(b.H, 1) + 0.5 * delay(b.L, 1) * (b.H - b.L) / b.V) * 100, 2 / 15),
    "g070": lambda b: std(b.A, 6),
    "g071": lambda b: (b.C - mean(b.C, 24)) / mean(b.C, 24) * 100,
    "g072": lambda b: ewm(wr(b, 6), 1 / 15),
    "g074": lambda b: (rank(corr(ssum(b.L * 0.35 + b.W * 0.65, 20), mean(b.V, 40), 7))
                       + rank(corr(rank(b.W), rank(b.V), 6))),
    "g075": lambda b: count((b.C > b.O) & (b.BC < b.BO), 50) / count(b.BC < b.BO, 50),
    "g076": lambda b: std(absolute(b.R) / b.V, 20) / mean(absolute(b.R) / b.V, 20),
    "g077": lambda b: small(rank(decay(mid(b) + b.H - (b.W + b.H), 20)),
                            rank(decay(corr(mid(b), mean(b.V, 40), 3), 6))),
    "g078": lambda b: (tp(b) - mean(tp(b), 12)) / (0.015 * mean(absolute(b.C - mean(tp(b), 12)), 12)),
    "g079": lambda b: ewm(big(b.C - b.P, 0), 1 / 12) / ewm(absolute(b.C - b.P), 1 / 12) * 100,
    "g080": lambda b: (b.V - delay(b.V, 5)) / delay(b.V, 5) * 100,
    "g081": lambda b: ewm(b.V, 2 / 21),
    "g082": lambda b: ewm(wr(b, 6), 1 / 20),
    "g083": lambda b: -corr(tsrank_pct(b.H, 250), tsrank_pct(b.V, 250), 5),
    "g084": lambda b: obv(b, d1(b), 20),
    "g085": lambda b: tsrank_pct(b.V / mean(b.V, 20), 20) * tsrank_pct(-delta(b.C, 7), 8),
    "g086": lambda b: where(bent(b) > 0.25, -1, where(bent(b) < 0, 1, -delta(b.C, 1))),
    "g087": lambda b: (rank(decay(delta(b.W, 4), 7))
                       + tsrank_pct(-decay((b.L - b.W) / (b.O - 0.5 * (b.H + b.L)), 11), 7)),
    "g088": lambda b: (b.C - delay(b.C, 20)) / delay(b.C, 20) * 100,
    "g089": lambda b: 2 * macd(b.C),
    "g090": lambda b: -rank(corr(rank(b.W), rank(b.V), 5)),
    "g091": lambda b: -rank(b.C - big(b.C, 5)) * rank(corr(mean(b.V, 40), b.L, 5)),
    "g092": lambda b: -big(rank(decay(delta(b.C * 0.35 + b.W * 0.65, 2), 3)),
                           tsrank_top(decay(absolute(corr(mean(b.V, 180), b.C, 13)), 5), 15)),
    "g093": lambda b: ssum(where(b.O >= delay(b.O, 1), 0, big(b.O - b.L, b.O - delay(b.O, 1))), 20),
    "g094": lambda b: obv(b, b.P, 30),
    "g095": lambda b: std(b.A, 20),
    "g096": lambda b: ewmn(ewmn(rsv(b, 9), span=5), span=5),
    "g097": lambda b: std(b.V, 10),
    "g098": lambda b: where((mean(b.C, 100) - delay(mean(b.C, 100), 100)) / delay(b.C, 100) <= 0.05,
                            -(b.C - tsmin(b.C, 100)), -delta(b.C, 3)),
    "g099": lambda b: -rank(cov(rank(b.C), rank(b.V), 5)),
    "g100": lambda b: std(b.V, 20),
    "g101": lambda b: where(rank(corr(b.C, ssum(mean(b.V, 30), 37), 15))
                            < rank(corr(rank(b.H * 0.1 + b.W * 0.9), rank(b.V), 11)), -1, 0),
    "g102": lambda b: ewmn(big(delta(b.V, 1), 0), span=11) / ewmn(absolute(delta(b.V, 1)), span=11) * 100,
    "g103": lambda b: (20 - lowday(b.L, 20)) / 20 * 100,
    "g104": lambda b: -delta(corr(b.H, b.V, 5), 5) * rank(std(b.C, 20)),
    "g105": lambda b: -corr(rank(b.O), rank(b.V), 10),
    "g106": lambda b: b.C - delay(b.C, 20),
    "g107": lambda b: -rank(b.O - delay(b.H, 1)) * rank(b.O - d1(b)) * rank(b.O - delay(b.L, 1)),
    "g108": lambda b: -power(rank(b.H - small(b.H, 2)), rank(corr(b.W, mean(b.V, 120), 6))),
    "g109": g109,
    "g110": lambda b: ssum(big(b.H - b.P, 0), 20) / ssum(big(b.P - b.L, 0), 20) * 100,
    "g111": lambda b: ewm(b.V * clv(b), span=10) - ewm(b.V * clv(b), span=3),
    "g112": g112,
    "g113": lambda b: (-rank(ssum(delay(b.C, 5), 20) / 20) * corr(b.C, b.V, 2)
                       * rank(corr(ssum(b.C, 5), ssum(b.C, 20), 2))),
    "g114": lambda b: rank(delay(spread(b), 2)) * rank(rank(b.V)) / (spread(b) / (b.W - b.C)),
    "g115": lambda b: power(rank(corr(b.H * 0.9 + b.C * 0.1, mean(b.V, 30), 10)),
                            rank(corr(tsrank_top(mid(b), 4), tsrank_top(b.V, 10), 7))),
    "g116": lambda b: regbeta(b.C, 20),
    "g117": lambda b: tsrank_pct(b.V, 32) * (1 - tsrank_pct(b.C + b.H - b.L, 16)) * (1 - tsrank_pct(b.R, 32)),
    "g118": lambda b: ssum(b.H - b.O, 20) / ssum(b.O - b.L, 20) * 100,
    "g119": lambda b: (rank(decay(corr(b.W, ssum(mean(b.V, 5), 26), 5), 7))
                       - rank(decay(tsrank_top(tsmin(corr(rank(b.O), rank(mean(b.V, 15)), 21), 9), 7), 8))),
    "g120": lambda b: rank(b.W - b.C) / rank(b.W + b.C),
    "g122": g122,
    "g123": lambda b: where(rank(corr(ssum(mid(b), 20), ssum(mean(b.V, 60), 20), 9)) < rank(corr(b.L, b.V, 6)),
                            -1, 0),
    "g124": g124,
    "g125": lambda b: (rank(decay(corr(b.W, mean(b.V, 80), 17), 20))
                       / rank(decay(delta(b.C * 0.5 + b.W * 0.5, 3), 16))),
    "g126": lambda b: (b.C + b.H + b.L) / 3,
    "g129": lambda b: ssum(absolute(small(delta(b.C, 1), 0)), 12),
    "g130": lambda b: (rank(decay(corr(mid(b), mean(b.V, 40), 9), 10))
                       / rank(decay(corr(rank(b.W), rank(b.V), 7), 3))),
    "g132": lambda b: mean(b.A, 20),
    "g133": lambda b: (20 - highday(b.H, 20)) / 20 * 100 - (20 - lowday(b.L, 20)) / 20 * 100,
    "g134": lambda b: (b.C / delay(b.C, 12) - 1) * b.V,
    "g135": lambda b: ewmn(delay(b.C / delay(b.C, 20), 1), 1 / 20),
    "g136": lambda b: -rank(delta(b.R, 3)) * corr(b.O, b.V, 10),
    "g138": lambda b: (tsrank_pct(decay(tsrank_top(corr(tsrank_top(b.L, 8), tsrank_top(mean(b.V, 60), 17), 5), 19),
                                        16), 7) - rank(decay(delta(b.L * 0.7 + b.W * 0.3, 3), 20))),
    "g139": lambda b: -corr(b.O, b.V, 10),
    "g140": lambda b: small(rank(decay(rank(b.O) + rank(b.L) - rank(b.H) - rank(b.C), 8)),
                            tsrank_pct(decay(corr(tsrank_top(b.C, 8), tsrank_top(mean(b.V, 60), 20), 8), 7), 3)),
    "g141": lambda b: -rank(corr(rank(b.H), rank(mean(b.V, 15)), 9)),
    "g142": lambda b: (-rank(tsrank_pct(b.C, 10)) * rank(delta(delta(b.C, 1), 1))
                       * rank(tsrank_pct(b.V / mean(b.V, 20), 5))),
    "g144": lambda b: sumif(absolute(b.C / b.P - 1) / b.A, 20, b.C < b.P) / count(b.C < b.P, 20),
    "g145": lambda b: (mean(b.V, 9) - mean(b.V, 26)) / mean(b.V, 12) * 100,
    "g148": lambda b: where(rank(corr(b.O, ssum(mean(b.V, 60), 9), 6)) < rank(b.O - tsmin(b.O, 14)), -1, 0),
    "g150": lambda b: (b.C + b.H + b.L) / 3 * b.V,
    "g152": g152,
    "g153": lambda b: (mean(b.C, 3) + mean(b.C, 6) + mean(b.C, 12) + mean(b.C, 24)) / 4,
    "g154": lambda b: where((b.W - tsmin(b.W, 16)) < corr(b.W, mean(b.V, 180), 18), 1, 0),
    "g155": lambda b: macd(b.V),
    "g156": g156,
    "g157": lambda b: (small(rank(rank(log(tsmin(rank(rank(-rank(delta(b.C - 1, 5)))), 2)))), 5)
                       + tsrank_top(delay(-(b.C / b.P - 1), 6), 5)),
    "g158": lambda b: ((b.H - ewmn(b.C, span=14)) - (b.L - ewmn(b.C, span=14))) / b.C,
    "g159": g159,
    "g160": lambda b: ewm(where(b.C <= d1(b), std(b.C, 20), 0), span=39),
    "g161": lambda b: mean(tr(b), 12),
    "g162": g162,
    "g163": lambda b: rank(-b.R * mean(b.V, 20) * b.W * (b.H - b.C)),
    "g164": g164,
    "g167": lambda b: ssum(big(delta(b.C, 1), 0), 12),
    "g168": lambda b: -b.V / mean(b.V, 20),
    "g169": g169,
    "g170": lambda b: (rank(1 / b.C) * b.V / mean(b.V, 20) * (rank(b.H - b.C) * b.H / mean(b.H, 5))
                       - rank(b.W - delay(b.W, 4))),
    "g171": lambda b: -(b.L - b.C) * power(b.O, 5) / ((b.C - b.H) * power(b.C, 5)),
    "g172": adx,
    "g173": g173,
    "g174": lambda b: ewmn(where(b.C > b.P, std(b.C, 20), 0), span=39),
    "g175": lambda b: mean(tr(b), 6),
    "g176": lambda b: corr(tsrank_pct(rsv(b, 12) / 100, 250), tsrank_pct(b.V, 250), 6),
    "g177": lambda b: (20 - highday(b.H, 20)) / 20 * 100,
    "g178": lambda b: (b.C - d1(b)) / d1(b) * b.V,
    "g179": lambda b: (rank(corr(b.W, b.V, 4))
                       * rank(corr(tsrank_pct(b.L, 250), tsrank_pct(mean(b.V, 50), 250), 12))),
    "g180": lambda b: where(mean(b.V, 20) < b.V, -tsrank_pct(absolute(delta(b.C, 7)), 60) * sign(delta(b.C, 7)),
                            -b.V),
    "g182": lambda b: count(((b.C > b.O) & (b.BO > b.BC)) | ((b.C < b.O) & (b.BO < b.BC)), 20) / 20,
    "g184": lambda b: rank(b.O - b.C) + rank(corr(delay(b.O - b.C, 1), b.C, 200)),
    "g185": lambda b: rank(-sq(1 - b.O / b.C)),
    "g186": lambda b: (adx(b) + delay(adx(b), 6)) / 2,
    "g187": lambda b: ssum(where(b.O <= delay(b.O, 1), 0, big(b.H - b.L, b.O - delay(b.O, 1))), 20),
    "g188": lambda b: ((b.H - b.L) - ewmn(b.H - b.L, span=10)) / ewmn(b.H - b.L, span=10) * 100,
    "g189": lambda b: mean(absolute(b.C - mean(b.C, 6)), 6),
    "g191": lambda b: corr(mean(b.V, 20), b.L, 5) + (b.H + b.L) / 2 - b.C,
}
