"""SQL text for the checks: common table expressions for the bars, and nested formulas spelt as chained CTEs.

This is checking code. It shares nothing with the Spark column builders: formulas are written here a second time,
from the published notation, and primitives use other identities (tie counts, regr_slope, closed-form weights).
"""

from __future__ import annotations

BARS = """
raw_bars as (
  select l_partkey % 24 as ticker, cast(date_trunc('week', l_shipdate) as date) as trade_date,
    l_extendedprice / nullif(l_quantity, 0) as px,
    row(l_shipdate::date, l_orderkey, l_linenumber, l_extendedprice, l_quantity) as ord, *
  from lineitem),
agg_bars as (
  select ticker, trade_date, arg_min(px, ord) as first_price, arg_max(px, ord) as close_price,
    max(px) as highest_price, min(px) as lowest_price, sum(l_quantity) as qty, sum(l_extendedprice) as val,
    count(*) as deal_amount, avg(l_discount) as disc, avg(l_tax) as tax,
    cast(date_diff('day', date '1995-01-02', trade_date) // 7 as bigint) as wk
  from raw_bars group by all),
flagged as (
  select *, (ticker * 7 + wk) % 41 = 0 as suspended,
    1000000 + 10000 * ticker + 5000 * (wk // 26) as shares,
    coalesce(lag(close_price) over (partition by ticker order by trade_date), first_price) as pre_close_price
  from agg_bars),
bars as (
  select ticker, trade_date, case when suspended then 0.0::double else first_price end as open_price,
    highest_price, lowest_price, close_price, pre_close_price,
    case when suspended then 0.0::double else qty end as turnover_vol,
    case when suspended then 0.0::double else val end as turnover_value,
    val / qty as vwap, deal_amount, suspended, shares,
    close_price / nullif(pre_close_price, 0) - 1 as chg_pct,
    close_price * shares as neg_market_value, close_price * shares * 1.5::double as market_value,
    case when suspended then 0.0::double else qty / shares end as turnover_rate,
    case when ticker = 5 and wk % 50 = 0 then 0.0::double else 10 + 100::double * disc end as pe,
    case when ticker = 5 and wk % 50 = 0 then 0.0::double else 1 + 10::double * tax end as pb,
    not suspended as is_open,
    case when ticker % 11 = 0 then '*ST' || ticker when ticker % 7 = 0 then 'ST' || ticker
         else 'N' || ticker end as sec_short_name,
    case when ticker % 2 = 0 then 'XSHG' else 'XSHE' end as exchange_cd, wk
  from flagged)"""

TRADED = BARS + """,
traded as (select * from bars where open_price > 0)"""

PANEL = TRADED + """,
s0 as (select t.ticker, t.trade_date, open_price as O, highest_price as H, lowest_price as L, close_price as C,
    turnover_vol as V, turnover_value as A, vwap as W, pre_close_price as P, neg_market_value as CAP,
    avg(open_price) over (partition by trade_date) as BO, avg(close_price) over (partition by trade_date) as BC,
    row_number() over (partition by ticker order by trade_date) as rn
  from traded t)"""


def with_bars(body: str) -> str:
    return f"with {BARS}\n{body}"


def with_traded(body: str) -> str:
    return f"with {TRADED}\n{body}"


def out(e: str) -> str:
    """How results are compared: 24 significant bits (Veltkamp split)."""
    k, down, up = "536870913.0::double", "pow(2.0, -100)", "pow(2.0, 100)"
    return (f"case when abs({e}) >= 1e290"
            f" then (({e}) * {down} * {k} - (({e}) * {down} * {k} - ({e}) * {down})) * {up}"
            f" else ({e}) * {k} - (({e}) * {k} - ({e})) end")


def sig(e: str) -> str:
    """39 significant bits."""
    return f"case when abs({e}) < 1e290 then ({e}) * 16385::double - (({e}) * 16385::double - ({e})) else ({e}) end"


def alike(a: str, b: str) -> str:
    return f"greatest(abs({a}), abs({b})) * pow(2.0::double, -39)"


class E:
    """SQL text of a formula plus the number of the CTE that has all its columns."""

    def __init__(self, book, sql, level):
        self.book, self.sql, self.level = book, sql, level

    def _mix(self, fmt, other):
        o = other if isinstance(other, E) else E(self.book, f"{float(other)!r}::double", 0)
        return E(self.book, fmt.format(a=self.sql, b=o.sql), max(self.level, o.level))

    def __add__(self, o): return self._mix("({a} + {b})", o)
    def __radd__(self, o): return self._mix("({b} + {a})", o)
    def __sub__(self, o): return self._mix("({a} - {b})", o)
    def __rsub__(self, o): return self._mix("({b} - {a})", o)
    def __mul__(self, o): return self._mix("({a} * {b})", o)
    def __rmul__(self, o): return self._mix("({b} * {a})", o)
    def __truediv__(self, o): return self._mix("({a} / nullif({b}, 0))", o)
    def __rtruediv__(self, o): return self._mix("({b} / nullif({a}, 0))", o)
    def __neg__(self): return E(self.book, f"(-{self.sql})", self.level)
    def __lt__(self, o): return self._mix(f"(({{b}} - {{a}}) > {alike('{a}', '{b}')})", o)
    def __gt__(self, o): return self._mix(f"(({{a}} - {{b}}) > {alike('{a}', '{b}')})", o)
    def __le__(self, o): return self._mix(f"(({{a}} - {{b}}) <= {alike('{a}', '{b}')})", o)
    def __ge__(self, o): return self._mix(f"(({{b}} - {{a}}) <= {alike('{a}', '{b}')})", o)
    def __and__(self, o): return self._mix("({a} and {b})", o)
    def __or__(self, o): return self._mix("({a} or {b})", o)
    def __pow__(self, o): return power(self, o)

    def same(self, o): return self._mix("({a} = {b})", o)


class Book:
    """Collects the columns that need a CTE of their own, one list per level."""

    def __init__(self):
        self.levels: list[dict[str, str]] = []

    def base(self, name):
        return E(self, name, 0)

    def column(self, sql, level):
        while len(self.levels) <= level:
            self.levels.append({})
        here = self.levels[level]
        if sql not in here:
            here[sql] = f"x{level}_{len(here)}"
        return E(self, here[sql], level + 1)

    def text(self, columns: dict[str, E]) -> str:
        parts = [f"with {PANEL}"]
        for i, level in enumerate(self.levels):
            cols = ",\n  ".join(f"{sql} as {name}" for sql, name in level.items())
            parts.append(f"s{i + 1} as (select *,\n  {cols}\n from s{i})")
        picked = ", ".join(f"{out(e.sql)} as {name}" for name, e in columns.items())
        return ",\n".join(parts) + f"\nselect ticker, trade_date, {picked} from s{len(self.levels)}"


# ---- elementwise

def _join(*xs):
    book = next(x.book for x in xs if isinstance(x, E))
    es = [x if isinstance(x, E) else E(book, f"{float(x)!r}::double", 0) for x in xs]
    return book, [e.sql for e in es], max(e.level for e in es)


def fn(fmt, *xs):
    book, sqls, level = _join(*xs)
    return E(book, fmt.format(*sqls), level)


def power(x, e):
    return fn("(case when isfinite(pow({0}, {1})) then pow({0}, {1}) end)", x, e)


def absolute(x): return fn("abs({0})", x)
def minus(x, y): return fn(f"(case when abs({{0}} - {{1}}) <= {alike('{0}', '{1}')} then 0.0::double else {{0}} - {{1}} end)", x, y)
def log(x): return fn("(case when {0} > 0 then ln({0}) end)", x)
def sign(x): return fn("sign({0})::double", x)


def rounded(x):
    """39 significant bits of x, a column of its own."""
    return x.book.column(sig(x.sql), x.level)



def big(x, y): return fn("(case when {0} is not null and {1} is not null then greatest({0}, {1}) end)", x, y)
def small(x, y): return fn("(case when {0} is not null and {1} is not null then least({0}, {1}) end)", x, y)
def where(c, x, y): return fn("(case when {0} then {1} else {2} end)", c, x, y)
def zero_for_null(x): return fn("coalesce({0}, 0)", x)
def or_else(x, y): return fn("coalesce({0}, {1})", x, y)
def unzero(x, k): return fn("(case when {0} = 0 then {1} else {0} end)", x, k)
def flag(c): return fn("(({0})::int::double)", c)


# ---- windows by ticker

TS = "(partition by ticker order by trade_date)"


def _w(n):
    return f"(partition by ticker order by trade_date rows between {n - 1} preceding and current row)"


def _ts(fmt, n, *xs, need=None):
    book, sqls, level = _join(*xs)
    body = fmt.format(*sqls, w=_w(n), n=n)
    guard = " and ".join(f"{s} is not null" for s in sqls)
    full = f"count(case when {guard} then 1 end) over {_w(n)} >= {n if need is None else need}"
    return book.column(f"case when {full} then {body} end", level)


def delay(x, n):
    return x.book.column(f"lag({x.sql}, {n}) over {TS}", x.level)


def delta(x, n): return x - delay(x, n)
def ret(b): return b.C / delay(b.C, 1) - 1
def ssum(x, n): return _ts("sum({0}) over {w}", n, x)
def mean(x, n): return _ts("avg({0}) over {w}", n, x)
def std(x, n): return _ts("stddev_samp({0}) over {w}", n, x)
def tsmin(x, n): return _ts("min({0}) over {w}", n, x)
def tsmax(x, n): return _ts("max({0}) over {w}", n, x)
def prod(x, n): return _ts("product({0}) over {w}", n, x)


def cov(x, y, n):
    return _ts("covar_samp({0}, {1}) over {w}", n, x, y)


def corr(x, y, n):
    mx = fn("(case when {1} is not null then {0} end)", x, y)
    my = fn("(case when {1} is not null then {0} end)", y, x)
    r = "covar_samp({0}, {1}) over {w} / (stddev_samp({0}) over {w} * stddev_samp({1}) over {w})"
    return _ts("case when stddev_samp({0}) over {w} > 1e-9 * abs(avg({0}) over {w})"
               " and stddev_samp({1}) over {w} > 1e-9 * abs(avg({1}) over {w})"
               f" then case when abs({r}) <= pow(2.0::double, -39) then 0.0::double when 1 - abs({r}) <= pow(2.0::double, -48)"
               " * (1 + abs(avg({0}) over {w}) / stddev_samp({0}) over {w} + abs(avg({1}) over {w}) / stddev_samp({1}) over {w})"
               f" then sign({r})::double else {r} end end", n, mx, my)


def tsrank(x, n):
    a = "list({0}) over {w}"
    return _ts(f"(len(list_filter({a}, lambda item: item < {{0}}))"
               f" + (len(list_filter({a}, lambda item: item = {{0}})) + 1) / 2.0::double)", n, rounded(x))


def tsrank_pct(x, n):
    return tsrank(x, n) / n


def tsrank_top(x, n):
    r = rounded(x)
    peak = _ts("max({0}) over {w}", n, r)
    tied = _ts("len(list_filter(list({0}) over {w}, lambda item: item = {1}))", n, r, peak, need=1)
    return tsrank(x, n) / (n - (tied - 1) / 2)


def argmax(x, n):
    return _ts("list_position(list({0}) over {w}, max({0}) over {w})::double", n, rounded(x))


def argmin(x, n):
    return _ts("list_position(list({0}) over {w}, min({0}) over {w})::double", n, rounded(x))


def highday(x, n): return (n + 1) - argmax(x, n)
def lowday(x, n): return (n + 1) - argmin(x, n)


def decay(x, n):
    return _ts("list_sum(list_transform(list({0}) over {w}, lambda item, i: item * i)) / ({n} * ({n} + 1) / 2.0::double)",
               n, x)


def regbeta(y, n):
    """Slope of y on the row number."""
    return _ts("regr_slope({0}, rn) over {w}", n, y)


def regbeta_index(x, n, t):
    """Slope of the row number on x, kept where the t statistic passes."""
    r2 = "(pow(covar_pop(rn, {0}) over {w}, 2) / (var_pop({0}) over {w} * var_pop(rn) over {w}))"
    return _ts("case when var_pop({0}) over {w} > 0 and sqrt(" + r2 + " * ({n} - 2) / nullif(1 - " + r2 + ", 0)) >= "
               + str(t) + " then regr_slope(rn, {0}) over {w} end", n, x)


def _alpha(alpha, span):
    return alpha if alpha is not None else 2 / (span + 1)


_LIST = "list({0}) over (partition by ticker order by trade_date rows unbounded preceding)"


def ewm(x, alpha=None, span=None):
    q = 1 - _alpha(alpha, span)
    h = x.book.column(_LIST.format(x.sql), x.level)
    num = f"list_sum(list_transform({h.sql}, lambda item, i: item * pow({q!r}::double, len({h.sql}) - i)))"
    den = (f"list_sum(list_transform({h.sql}, lambda item, i: "
           f"case when item is null then 0 else pow({q!r}::double, len({h.sql}) - i) end))")
    return x.book.column(f"{num} / nullif({den}, 0)", h.level)


def ewmn(x, alpha=None, span=None):
    """Recursive mean, folded over the whole history with pandas' ageing of the old weight in a gap."""
    a = _alpha(alpha, span)
    q = 1 - a
    items = x.book.column("list(struct_pack(m := {0}, w := 1.0::double)) over (partition by ticker order by trade_date"
                          " rows unbounded preceding)".format(x.sql), x.level)
    return x.book.column(
        f"list_reduce({items.sql}, lambda acc, item: case when item.m is null then struct_pack(m := acc.m, w := acc.w * {q!r}::double)"
        f" when acc.m is null then item"
        f" else struct_pack(m := (acc.w * {q!r}::double * acc.m + {a!r}::double * item.m) / (acc.w * {q!r}::double + {a!r}::double), w := 1.0::double) end).m",
        items.level)


def count(c, n): return ssum(where(c, 1, 0), n)
def sumif(x, n, c): return ssum(where(c, x, 0), n)


# ---- windows by trade date

def rank(x):
    r = rounded(x)
    return x.book.column(
        f"case when {r.sql} is not null then"
        f" (rank() over (partition by trade_date order by {r.sql} nulls last)"
        f" + (count(*) over (partition by trade_date, {r.sql}) - 1) / 2.0::double)"
        f" / count({r.sql}) over (partition by trade_date) end", r.level)


def scale(x, k=1):
    return x.book.column(f"{x.sql} * {k} / nullif(sum(abs({x.sql})) over (partition by trade_date), 0)", x.level)


class Inputs:
    def __init__(self):
        book = self.book = Book()
        for name in ("O", "H", "L", "C", "V", "A", "W", "P", "CAP", "BO", "BC"):
            setattr(self, name, book.base(name))

    @property
    def R(self):
        return ret(self)

    def adv(self, n):
        return mean(self.V, n)


def factor_sql(formulas: dict) -> str:
    b = Inputs()
    return b.book.text({name: f(b) for name, f in formulas.items()})
