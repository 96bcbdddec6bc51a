"""Randomised checks against brute force in plain Python on small inputs."""

import datetime as dt
import math
from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ratecraft.operators import dedup_latest, monthly_mart, monthly_rates, monthly_reference

SETTINGS = settings(
    max_examples=12,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow],
)
START = dt.date(2020, 1, 1)

daily_rows = st.lists(
    st.tuples(
        st.sampled_from(["a", "a", "a", "b", "c"]),  # "a" is a hot key
        st.integers(min_value=0, max_value=700),  # day offset, about two years
        st.decimals(min_value="-0.9", max_value="2.5", places=4).map(float),
    ),
    min_size=1,
    max_size=120,
)
monthly_rows = st.dictionaries(
    st.integers(min_value=0, max_value=23),  # month offset; some months missing
    st.decimals(min_value="-1.5", max_value="3", places=3).map(float),
    min_size=1,
    max_size=24,
)


def month_start(day: int) -> dt.date:
    d = START + dt.timedelta(days=day)
    return d.replace(day=1)


def add_months(d: dt.date, n: int) -> dt.date:
    y, m = divmod(d.month - 1 + n, 12)
    return dt.date(d.year + y, m + 1, 1)


def compounded(rates):
    return (math.prod(1 + r / 100 for r in rates) - 1) * 100


def fisher(n, p):
    return ((1 + n / 100) / (1 + p / 100) - 1) * 100


def expected_mart(daily, reference, months=12):
    groups = defaultdict(list)
    for key, day, rate in daily:
        groups[(key, month_start(day))].append(rate)
    out = {}
    by_key = defaultdict(list)
    for (key, month), rates in groups.items():
        if month in reference:
            by_key[key].append((month, sum(rates) / len(rates), compounded(rates), len(rates)))
    for key, rows in by_key.items():
        rows.sort()
        for i, (month, avg, eff, n) in enumerate(rows):
            frame = rows[max(0, i - months + 1) : i + 1]
            full = len(frame) == months
            acc_n = compounded([r[2] for r in frame])
            acc_p = compounded([reference[r[0]] for r in frame])
            p = reference[month]
            out[(key, month)] = (
                avg, eff, p, fisher(eff, p),
                acc_n if full else None, acc_p if full else None,
                fisher(acc_n, acc_p) if full else None, n,
            )
    return out


def close(got, want):
    if want is None or got is None:
        return got is None and want is None
    return abs(float(got) - want) <= 2e-8 + 1e-9 * abs(want)


@SETTINGS
@given(daily=daily_rows, reference_offsets=monthly_rows)
def test_keyed_mart_matches_brute_force(spark, daily, reference_offsets):
    reference = {add_months(START, k): v for k, v in reference_offsets.items()}
    daily_df = spark.createDataFrame(
        [(k, START + dt.timedelta(days=d), r) for k, d, r in daily], "k string, d date, r double"
    )
    ref_df = spark.createDataFrame(list(reference.items()), "reference_month date, p double")
    mart = monthly_mart(
        monthly_rates(daily_df, "r", date_col="d", keys=["k"]),
        monthly_reference(ref_df, "p"),
        keys=["k"],
    )
    got = {(r.k, r.reference_month): r for r in mart.collect()}
    want = expected_mart(daily, reference)
    assert set(got) == set(want)
    for key, row in got.items():
        w = want[key]
        vals = (
            row.nominal_daily_average_pct, row.nominal_monthly_effective_pct,
            row.inflation_monthly_pct, row.real_interest_monthly_pct,
            row.nominal_accumulated_12m_pct, row.inflation_accumulated_12m_pct,
            row.real_interest_accumulated_12m_pct,
        )
        assert all(close(g, x) for g, x in zip(vals, w[:7])), (key, vals, w)
        assert row.nominal_observation_count == w[7]


@SETTINGS
@given(
    rows=st.lists(
        st.tuples(
            st.sampled_from(["hot", "hot", "hot", "x", "y", "z"]),
            st.integers(min_value=0, max_value=5),  # first order column, many ties
            st.integers(min_value=0, max_value=1000),  # tie-break
            st.integers(min_value=-50, max_value=50),
        ),
        min_size=1,
        max_size=200,
    )
)
def test_dedup_latest_matches_brute_force(spark, rows):
    # the order (t desc, id desc) is total only when (key, t, id) is unique
    unique = {(k, t, i): v for k, t, i, v in rows}
    df = spark.createDataFrame([(k, t, i, v) for (k, t, i), v in unique.items()], "k string, t int, id int, v int")
    got = {
        r.k: (r.t, r.id, r.v)
        for r in dedup_latest(df, ["k"], [F.col("t").desc(), F.col("id").desc()]).collect()
    }
    want = {}
    for (k, t, i), v in unique.items():
        if k not in want or (t, i) > want[k][:2]:
            want[k] = (t, i, v)
    assert got == want


def test_hot_key_with_a_third_of_rows_keeps_every_row_in_its_aggregate(spark):
    n = 30_000
    rows = [("hot" if i % 3 == 0 else f"k{i % 97}", START + dt.timedelta(days=i % 60), 0.01) for i in range(n)]
    df = spark.createDataFrame(rows, "k string, d date, r double")
    counts = monthly_rates(df, "r", date_col="d", keys=["k"]).groupBy("k").agg(
        F.sum("nominal_observation_count").alias("n")
    )
    got = {r.k: r.n for r in counts.collect()}
    assert got["hot"] == n // 3
    assert sum(got.values()) == n


# -- parsing: decimal(18,8) half-up, ',' as decimal mark, NULL on bad input ----

from decimal import ROUND_HALF_UP, Decimal, InvalidOperation  # noqa: E402

from ratecraft.functions import parse_date, parse_rate  # noqa: E402


def expected_rate(text: str):
    try:
        value = Decimal(text.replace(",", "."))
    except InvalidOperation:
        return None
    if not value.is_finite():
        return None
    rounded = value.quantize(Decimal("1e-8"), rounding=ROUND_HALF_UP)
    return rounded if abs(rounded) < Decimal("1e10") else None


rate_texts = st.one_of(
    st.decimals(min_value="-99999999999", max_value="99999999999", places=10, allow_nan=False).map(
        lambda d: format(d, "f")
    ),
    st.decimals(min_value="-100", max_value="100", places=6, allow_nan=False).map(
        lambda d: format(d, "f").replace(".", ",")
    ),
    st.sampled_from(["1.234,56", "abc", "", "1,2,3", "--1", "0,0000000050", "0.000000005", "-0,000000005"]),
)


@SETTINGS
@given(texts=st.lists(rate_texts, min_size=1, max_size=60))
def test_parse_rate_matches_decimal_rounding(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: r.v for r in df.select("i", parse_rate("t").alias("v")).collect()}
    for i, t in enumerate(texts):
        assert got[i] == expected_rate(t), (t, got[i])


@SETTINGS
@given(
    days=st.lists(st.dates(min_value=dt.date(1900, 1, 1), max_value=dt.date(2099, 12, 31)), min_size=1, max_size=40),
    bad=st.lists(st.sampled_from(["31/02/2020", "2020-01-31", "1/2/2020", "00/01/2020", "xx", ""]), max_size=5),
)
def test_parse_date_round_trips_and_rejects(spark, days, bad):
    texts = [d.strftime("%d/%m/%Y") for d in days] + bad
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: r.d for r in df.select("i", parse_date("t").alias("d")).collect()}
    for i, d in enumerate(days):
        assert got[i] == d
    for i in range(len(days), len(texts)):
        assert got[i] is None, texts[i]


# -- quality report: one pass, counted per key then summed ---------------------

from collections import Counter  # noqa: E402

from ratecraft.operators import dq_report  # noqa: E402
from ratecraft.specs import RuleSet  # noqa: E402


@SETTINGS
@given(
    rows=st.lists(
        st.tuples(
            st.one_of(st.none(), st.sampled_from([0, 0, 0, 1, 2, 3, 4])),  # 0 is a hot key
            st.one_of(st.none(), st.integers(min_value=-5, max_value=15)),
        ),
        max_size=80,
    ),
    keyed=st.booleans(),
)
def test_dq_report_matches_brute_force(spark, rows, keyed):
    rules = RuleSet(
        dataset="t",
        required=("k", "v"),
        unique_key=("k",) if keyed else (),
        ranges=(("v", 0, 10),),
        positive=("v",),
    )
    df = spark.createDataFrame(rows, "k int, v int")
    got = {r.rule: (r.checked, r.violations) for r in dq_report(df, rules).collect()}
    n = len(rows)
    want = {
        "not_empty": (n, int(n == 0)),
        "not_null(k,v)": (n, sum(k is None or v is None for k, v in rows)),
        "in_range(v,0,10)": (n, sum(v is not None and not 0 <= v <= 10 for _, v in rows)),
        "positive(v)": (n, sum(v is not None and v <= 0 for _, v in rows)),
    }
    if keyed:
        per_key = Counter(k for k, _ in rows)  # NULL keys form one group, as in GROUP BY
        want["unique_key(k)"] = (len(per_key), sum(c > 1 for c in per_key.values()))
    assert got == want


# -- upsert: the result equals a dictionary update by key ----------------------

import uuid  # noqa: E402

from ratecraft.operators import upsert  # noqa: E402
from ratecraft.sources import read_table  # noqa: E402

keyed_rows = st.dictionaries(
    st.integers(min_value=0, max_value=40), st.integers(min_value=-100, max_value=100), max_size=30
)


@SETTINGS
@given(target=keyed_rows, source=keyed_rows, partitioned=st.booleans())
def test_upsert_matches_dictionary_update(spark, tmp_path, target, source, partitioned):
    path = str(tmp_path / uuid.uuid4().hex)
    schema = "v int, k int, part int"  # key not first; the partition follows from the key

    def frame(d):
        return spark.createDataFrame([(v, k, k // 10) for k, v in d.items()], schema)

    parts = ("part",) if partitioned else ()
    upsert(spark, frame(target), path, ["k"], partition_by=parts)
    upsert(spark, frame(source), path, ["k"], partition_by=parts)
    got = {r.k: (r.v, r.part) for r in read_table(spark, path).collect()}
    want = {k: (v, k // 10) for k, v in {**target, **source}.items()}
    assert got == want


# -- frame gaps: 12-row frames that span more calendar months than rows --------

from ratecraft.operators import frame_gaps  # noqa: E402


@SETTINGS
@given(
    series=st.dictionaries(
        st.sampled_from(["a", "b", "c"]),
        st.sets(st.integers(min_value=0, max_value=40), min_size=1, max_size=30),
        min_size=1,
    )
)
def test_frame_gaps_matches_brute_force(spark, series):
    rows = [(s, add_months(START, m)) for s, months in series.items() for m in months]
    df = spark.createDataFrame(rows, "s string, reference_month date")
    got = {(r.s, r.reference_month): (r.months_in_window, r.months_spanned) for r in frame_gaps(df, keys=["s"]).collect()}
    want = {}
    for s, months in series.items():
        ordered = sorted(months)
        for i, m in enumerate(ordered):
            frame = ordered[max(0, i - 11) : i + 1]
            spanned = m - frame[0] + 1
            if spanned != len(frame):
                want[(s, add_months(START, m))] = (len(frame), spanned)
    assert got == want


# -- dropped months: what the inner join on month silently drops ---------------

from ratecraft.operators import dropped_months  # noqa: E402


@SETTINGS
@given(
    nominal=st.dictionaries(
        st.sampled_from(["a", "b"]), st.sets(st.integers(min_value=0, max_value=20), min_size=1, max_size=15), min_size=1
    ),
    reference=st.sets(st.integers(min_value=0, max_value=20), max_size=15),
)
def test_dropped_months_matches_brute_force(spark, nominal, reference):
    nom = spark.createDataFrame(
        [(s, add_months(START, m), 1.0) for s, ms in nominal.items() for m in ms],
        "series_name string, reference_month date, nominal_monthly_effective_pct double",
    )
    ref = spark.createDataFrame(
        [(add_months(START, m), 0.5) for m in reference], "reference_month date, inflation_monthly_pct double"
    )
    got = [
        (r.series_name, r.reference_month, r.side)
        for r in dropped_months(nom, ref, keys=["series_name"]).collect()
    ]
    want = sorted(
        [(s, add_months(START, m), "nominal_only") for s, ms in nominal.items() for m in ms if m not in reference]
        + [(s, add_months(START, m), "reference_only") for s, ms in nominal.items() for m in reference - ms]
    )
    assert sorted(got) == want
