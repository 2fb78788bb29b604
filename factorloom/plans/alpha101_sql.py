"""The same 83 factors as nested formulas for the SQL check."""

from __future__ import annotations

from .sql import (absolute, argmax, argmin, big, corr, cov, decay, delay, delta, log, mean, minus, or_else, power, prod, rank,
                  scale, sign, small, ssum, std, tsmax, tsmin, tsrank, unzero, where, zero_for_null)


def lt(x, y):
    return where(x < y, -1, 0)


def mid(b):
    return (b.H + b.L) / 2


def curve(b):
    return (delay(b.C, 20) - delay(b.C, 10)) / 10 - (delay(b.C, 10) - b.C) / 10


def f009(b, n):
    d = delta(b.C, 1)
    return where(0 < tsmin(d, n), d, where(tsmax(d, n) < 0, d, -d))


def squared(x):
    return x * x


def f001(b):
    x = where(b.R < 0, std(b.R, 20), b.C)
    return rank(argmax(x * x, 5)) - 0.5


def f021(b):
    m, s, m2 = ssum(b.C, 8) / 8, std(b.C, 8), ssum(b.C, 2) / 2
    return where(m + s < m2, -1, where(m2 < m - s, 1, where(b.V / b.adv(20) >= 1, 1, -1)))


def f027(b):
    z = rank(ssum(corr(rank(b.V), rank(b.W), 6), 2) / 2)
    return where(z > 0.5, -1, where(z <= 0.5, 1, z))


def f073(b):
    m = b.O * 0.147155 + b.L * (1 - 0.147155)
    return -big(rank(decay(delta(b.W, 5), 3)), tsrank(decay(-(delta(m, 2) / m), 3), 17))


FORMULAS = {
    "f001": f001,
    "f002": lambda b: zero_for_null(-corr(rank(delta(log(b.V), 2)), rank((b.C - b.O) / b.O), 6)),
    "f003": lambda b: zero_for_null(-corr(rank(b.O), rank(b.V), 10)),
    "f004": lambda b: -tsrank(rank(b.L), 9),
    "f005": lambda b: rank(b.O - ssum(b.W, 10) / 10) * -absolute(rank(b.C - b.W)),
    "f006": lambda b: zero_for_null(-corr(b.O, b.V, 10)),
    "f007": lambda b: where(b.adv(20) >= b.V, -1, -tsrank(absolute(delta(b.C, 7)), 60) * sign(delta(b.C, 7))),
    "f008": lambda b: -rank(ssum(b.O, 5) * ssum(b.R, 5) - delay(ssum(b.O, 5) * ssum(b.R, 5), 10)),
    "f009": lambda b: f009(b, 5),
    "f010": lambda b: rank(f009(b, 4)),
    "f011": lambda b: (rank(tsmax(b.W - b.C, 3)) + rank(tsmin(b.W - b.C, 3))) * rank(delta(b.V, 3)),
    "f012": lambda b: sign(delta(b.V, 1)) * -delta(b.C, 1),
    "f013": lambda b: -rank(cov(rank(b.C), rank(b.V), 5)),
    "f014": lambda b: -rank(delta(b.R, 3)) * zero_for_null(corr(b.O, b.V, 10)),
    "f015": lambda b: -ssum(rank(zero_for_null(corr(rank(b.H), rank(b.V), 3))), 3),
    "f016": lambda b: -rank(cov(rank(b.H), rank(b.V), 5)),
    "f017": lambda b: -rank(tsrank(b.C, 10)) * rank(delta(delta(b.C, 1), 1)) * rank(tsrank(b.V / b.adv(20), 5)),
    "f018": lambda b: -rank(std(absolute(b.C - b.O), 5) + (b.C - b.O) + zero_for_null(corr(b.C, b.O, 10))),
    "f019": lambda b: -sign((b.C - delay(b.C, 7)) + delta(b.C, 7)) * (1 + rank(1 + ssum(b.R, 250))),
    "f020": lambda b: -rank(b.O - delay(b.H, 1)) * rank(b.O - delay(b.C, 1)) * rank(b.O - delay(b.L, 1)),
    "f021": f021,
    "f022": lambda b: -(delta(zero_for_null(corr(b.H, b.V, 5)), 5) * rank(std(b.C, 20))),
    "f023": lambda b: where(ssum(b.H, 20) / 20 < b.H, zero_for_null(-delta(b.H, 2)), 0),
    "f024": lambda b: where(delta(ssum(b.C, 100) / 100, 100) / delay(b.C, 100) <= 0.05,
                            -(b.C - tsmin(b.C, 100)), -delta(b.C, 3)),
    "f025": lambda b: rank(-b.R * b.adv(20) * b.W * (b.H - b.C)),
    "f026": lambda b: -tsmax(zero_for_null(corr(tsrank(b.V, 5), tsrank(b.H, 5), 5)), 3),
    "f027": f027,
    "f028": lambda b: scale(zero_for_null(corr(b.adv(20), b.L, 5)) + mid(b) - b.C),
    "f029": lambda b: (tsmin(prod(rank(rank(scale(log(ssum(tsmin(rank(rank(-rank(delta(b.C - 1, 5)))), 2), 1))))),
                                  1), 5) + tsrank(delay(-b.R, 6), 5)),
    "f030": lambda b: ((1 - rank(sign(b.C - delay(b.C, 1)) + sign(delay(b.C, 1) - delay(b.C, 2))
                                 + sign(delay(b.C, 2) - delay(b.C, 3)))) * ssum(b.V, 5) / ssum(b.V, 20)),
    "f031": lambda b: (rank(rank(rank(decay(-rank(rank(delta(b.C, 10))), 10)))) + rank(-delta(b.C, 3))
                       + sign(scale(zero_for_null(corr(b.adv(20), b.L, 12))))),
    "f032": lambda b: scale(ssum(b.C, 7) / 7 - b.C) + 20 * scale(corr(b.W, delay(b.C, 5), 230)),
    "f033": lambda b: rank(-(1 - b.O / b.C)),
    "f034": lambda b: rank((1 - rank(or_else(std(b.R, 2) / std(b.R, 5), 1))) + (1 - rank(delta(b.C, 1)))),
    "f035": lambda b: tsrank(b.V, 32) * (1 - tsrank(b.C + b.H - b.L, 16)) * (1 - tsrank(b.R, 32)),
    "f036": lambda b: (2.21 * rank(corr(b.C - b.O, delay(b.V, 1), 15)) + 0.7 * rank(b.O - b.C)
                       + 0.73 * rank(tsrank(delay(-b.R, 6), 5)) + rank(absolute(corr(b.W, b.adv(20), 6)))
                       + 0.6 * rank((ssum(b.C, 200) / 200 - b.O) * (b.C - b.O))),
    "f037": lambda b: rank(corr(delay(b.O - b.C, 1), b.C, 200)) + rank(b.O - b.C),
    "f038": lambda b: -rank(tsrank(b.C, 10)) * rank(or_else(b.C / b.O, 1)),
    "f039": lambda b: -rank(delta(b.C, 7) * (1 - rank(decay(b.V / b.adv(20), 9)))) * (1 + rank(ssum(b.R, 250))),
    "f040": lambda b: -rank(std(b.H, 10)) * corr(b.H, b.V, 10),
    "f041": lambda b: power(b.H * b.L, 0.5) - b.W,
    "f042": lambda b: rank(b.W - b.C) / rank(b.W + b.C),
    "f043": lambda b: tsrank(b.V / b.adv(20), 20) * tsrank(-delta(b.C, 7), 8),
    "f044": lambda b: zero_for_null(-corr(b.H, rank(b.V), 5)),
    "f045": lambda b: -(rank(ssum(delay(b.C, 5), 20) / 20) * zero_for_null(corr(b.C, b.V, 2))
                        * rank(corr(ssum(b.C, 5), ssum(b.C, 20), 2))),
    "f046": lambda b: where(curve(b) > 0.25, -1, where(curve(b) < 0, 1, -(b.C - delay(b.C, 1)))),
    "f047": lambda b: (rank(1 / b.C) * b.V / b.adv(20) * (b.H * rank(b.H - b.C) / (ssum(b.H, 5) / 5))
                       - rank(b.W - delay(b.W, 5))),
    "f049": lambda b: where(curve(b) < -0.1, 1, -(b.C - delay(b.C, 1))),
    "f050": lambda b: -tsmax(rank(corr(rank(b.V), rank(b.W), 5)), 5),
    "f051": lambda b: where(curve(b) < -0.05, 1, -(b.C - delay(b.C, 1))),
    "f052": lambda b: ((-tsmin(b.L, 5) + delay(tsmin(b.L, 5), 5)) * rank((ssum(b.R, 240) - ssum(b.R, 20)) / 220)
                       * tsrank(b.V, 5)),
    "f053": lambda b: -delta(((b.C - b.L) - (b.H - b.C)) / unzero(b.C - b.L, 0.0001), 9),
    "f054": lambda b: -((b.L - b.C) * power(b.O, 5)) / (unzero(b.L - b.H, -0.0001) * power(b.C, 5)),
    "f055": lambda b: zero_for_null(-corr(rank((b.C - tsmin(b.L, 12)) / unzero(tsmax(b.H, 12) - tsmin(b.L, 12),
                                                                               0.0001)), rank(b.V), 6)),
    "f056": lambda b: 0 - rank(ssum(b.R, 10) / ssum(ssum(b.R, 2), 3)) * rank(b.R * b.CAP),
    "f057": lambda b: 0 - (b.C - b.W) / decay(rank(argmax(b.C, 30)), 2),
    "f060": lambda b: minus(scale(rank(argmax(b.C, 10))),
                            2 * scale(rank(((b.C - b.L) - (b.H - b.C)) / unzero(b.H - b.L, 0.0001) * b.V))),
    "f061": lambda b: where(rank(b.W - tsmin(b.W, 16)) < rank(corr(b.W, b.adv(180), 18)), 1, 0),
    "f062": lambda b: lt(rank(corr(b.W, ssum(b.adv(20), 22), 10)),
                         rank(where(rank(b.O) + rank(b.O) < rank(mid(b)) + rank(b.H), 1, 0))),
    "f064": lambda b: lt(rank(corr(ssum(b.O * 0.178404 + b.L * (1 - 0.178404), 13), ssum(b.adv(120), 13), 17)),
                         rank(delta(mid(b) * 0.178404 + b.W * (1 - 0.178404), 4))),
    "f065": lambda b: lt(rank(corr(b.O * 0.00817205 + b.W * (1 - 0.00817205), ssum(b.adv(60), 9), 6)),
                         rank(b.O - tsmin(b.O, 14))),
    "f066": lambda b: -(rank(decay(delta(b.W, 4), 7))
                        + tsrank(decay((b.L * 0.96633 + b.L * (1 - 0.96633) - b.W) / (b.O - mid(b)), 11), 7)),
    "f068": lambda b: lt(tsrank(corr(rank(b.H), rank(b.adv(15)), 9), 14),
                         rank(delta(b.C * 0.518371 + b.L * (1 - 0.518371), 1))),
    "f071": lambda b: big(tsrank(decay(corr(tsrank(b.C, 3), tsrank(b.adv(180), 12), 18), 4), 16),
                          tsrank(decay(squared(rank(b.L + b.O - (b.W + b.W))), 16), 4)),
    "f072": lambda b: (rank(decay(corr(mid(b), b.adv(40), 9), 10))
                       / rank(decay(corr(tsrank(b.W, 4), tsrank(b.V, 19), 7), 3))),
    "f073": f073,
    "f074": lambda b: lt(rank(corr(b.C, ssum(b.adv(30), 37), 15)),
                         rank(corr(rank(b.H * 0.0261661 + b.W * (1 - 0.0261661)), rank(b.V), 11))),
    "f075": lambda b: where(rank(corr(b.W, b.V, 4)) < rank(corr(rank(b.L), rank(b.adv(50)), 12)), 1, 0),
    "f077": lambda b: small(rank(decay(mid(b) + b.H - (b.W + b.H), 20)),
                            rank(decay(corr(mid(b), b.adv(40), 3), 6))),
    "f078": lambda b: power(rank(corr(ssum(b.L * 0.352233 + b.W * (1 - 0.352233), 20), ssum(b.adv(40), 20), 7)),
                            rank(corr(rank(b.W), rank(b.V), 6))),
    "f081": lambda b: lt(rank(log(prod(rank(power(rank(corr(b.W, ssum(b.adv(10), 50), 8)), 4)), 15))),
                         rank(corr(rank(b.W), rank(b.V), 5))),
    "f083": lambda b: (rank(delay((b.H - b.L) / (ssum(b.C, 5) / 5), 2)) * rank(rank(b.V))
                       / ((b.H - b.L) / (ssum(b.C, 5) / 5) / (b.W - b.C))),
    "f084": lambda b: power(tsrank(b.W - tsmax(b.W, 15), 21), delta(b.C, 5)),
    "f085": lambda b: power(rank(corr(b.H * 0.876703 + b.C * (1 - 0.876703), b.adv(30), 10)),
                            rank(corr(tsrank(mid(b), 4), tsrank(b.V, 10), 7))),
    "f086": lambda b: lt(tsrank(corr(b.C, ssum(b.adv(20), 15), 6), 20), rank((b.O + b.C) - (b.W + b.O))),
    "f088": lambda b: small(rank(decay((rank(b.O) + rank(b.L)) - (rank(b.H) + rank(b.C)), 8)),
                            tsrank(decay(corr(tsrank(b.C, 8), tsrank(b.adv(60), 21), 8), 7), 3)),
    "f092": lambda b: small(tsrank(decay(where(mid(b) + b.C < b.L + b.O, 1, 0), 15), 19),
                            tsrank(decay(corr(rank(b.L), rank(b.adv(30)), 8), 7), 7)),
    "f094": lambda b: -power(rank(b.W - tsmin(b.W, 12)), tsrank(corr(tsrank(b.W, 20), tsrank(b.adv(60), 4), 18), 3)),
    "f095": lambda b: where(rank(b.O - tsmin(b.O, 12))
                            < tsrank(power(rank(corr(ssum(mid(b), 19), ssum(b.adv(40), 19), 13)), 5), 12), 1, 0),
    "f096": lambda b: -big(tsrank(decay(corr(rank(b.W), rank(b.V), 4), 4), 8),
                           tsrank(decay(argmax(corr(tsrank(b.C, 7), tsrank(b.adv(60), 4), 4), 13), 14), 13)),
    "f098": lambda b: (rank(decay(corr(b.W, ssum(b.adv(5), 26), 5), 7))
                       - rank(decay(tsrank(argmin(corr(rank(b.O), rank(b.adv(15)), 21), 9), 7), 8))),
    "f099": lambda b: lt(rank(corr(ssum(mid(b), 20), ssum(b.adv(60), 20), 9)), rank(corr(b.L, b.V, 6))),
    "f101": lambda b: (b.C - b.O) / ((b.H - b.L) + 0.001),
}
