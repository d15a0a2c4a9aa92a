"""Property tests for upserts on random small frames (hypothesis)."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from snaplake.operators.incremental import upsert
from snaplake.sinks import tables

SCHEMA = "k string, v int, uf string, _competencia string"
KEYS = st.sampled_from(["a", "b", "c", "d", None])
UFS = st.sampled_from(["AC", "SP", "RJ"])


def batch(month):
    row = st.tuples(KEYS, st.integers(0, 5), UFS, st.just(month))
    return st.lists(row, min_size=0, max_size=8)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple((x is None, str(x)) for x in t))


SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(first=batch("2026-01"), second=batch("2026-02"))
def test_sequence_of_loads_equals_full_load(spark, first, second):
    s1 = spark.createDataFrame(first, SCHEMA)
    s2 = spark.createDataFrame(second, SCHEMA)
    seq = upsert(upsert(None, s1, ["k"]), s2, ["k"])
    full = upsert(None, s1.unionByName(s2), ["k"])
    assert rows(seq) == rows(full)
    months = {}
    for r in rows(seq):
        if r[0] is not None:
            months.setdefault(r[0], set()).add(r[3])
    assert all(len(m) == 1 for m in months.values())     # one month per key


@SETTINGS
@given(first=batch("2026-01"), second=batch("2026-02"))
def test_upsert_is_idempotent(spark, first, second):
    t = upsert(None, spark.createDataFrame(first, SCHEMA), ["k"])
    s = spark.createDataFrame(second, SCHEMA)
    once = upsert(t, s, ["k"])
    assert rows(upsert(once, s, ["k"])) == rows(once)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(first=batch("2026-01"), second=batch("2026-02"))
def test_partitioned_merge_equals_upsert(spark, scratch, first, second):
    import uuid
    root = f"{scratch}/{uuid.uuid4().hex}"
    t = upsert(None, spark.createDataFrame(first, SCHEMA), ["k"])
    s = spark.createDataFrame(second, SCHEMA)
    tables.write_version(t, root, partition_by=["uf"])
    out = tables.merge_into(spark, root, s, ["k"], partition_by=["uf"])
    assert rows(out) == rows(upsert(t, s, ["k"]))        # no stale rows, nothing lost


FIELD = st.text(alphabet=st.sampled_from(list("ab ;\"\né0")), max_size=6)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows_=st.lists(st.lists(FIELD, min_size=1, max_size=5), min_size=1, max_size=12),
       quote_all=st.booleans())
def test_arrow_parser_equals_python_rules(spark, scratch, rows_, quote_all):
    """The pyarrow fast path and the plain csv-module path read the same
    rows from any extract: quotes, separators, newlines, short/long rows."""
    import csv
    import io
    import uuid
    import zipfile

    from snaplake.sources.zip_csv import read_zips

    buf = io.StringIO()
    w = csv.writer(buf, delimiter=";", quotechar='"', lineterminator="\n",
                   quoting=csv.QUOTE_ALL if quote_all else csv.QUOTE_MINIMAL)
    for r in rows_:
        w.writerow(r)
    path = f"{scratch}/{uuid.uuid4().hex}.zip"
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("x.csv", buf.getvalue().encode("latin-1"))
    cols = ["c1", "c2", "c3"]
    got = {p: rows(read_zips(spark, path, columns=cols, parser=p).drop("_arquivo_origem"))
           for p in ["arrow", "python"]}
    assert got["arrow"] == got["python"]


EST_ROW = st.tuples(
    st.sampled_from(["01", "02", "03", "04", "08", None]),          # status
    st.one_of(st.none(), st.dates(min_value=__import__("datetime").date(2023, 1, 1),
                                  max_value=__import__("datetime").date(2023, 4, 30))),
    st.one_of(st.none(), st.dates(min_value=__import__("datetime").date(2023, 1, 1),
                                  max_value=__import__("datetime").date(2023, 4, 30))),
    st.sampled_from(["0000001", "0000002", None]),                    # activity code
    st.sampled_from(["AC", "SP", None]),                              # state
)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=st.lists(EST_ROW, max_size=25), null_safe=st.booleans())
def test_one_pass_dynamics_equals_join_formulation(spark, data, null_safe):
    from snaplake.plans import gold
    core = spark.createDataFrame(
        data, "cod_situacao_cadastral string, data_situacao_cadastral date, "
              "data_inicio_atividade date, cod_cnae_principal string, uf string")
    cn = spark.createDataFrame([("0000001", "X")], "codigo string, descricao string")
    one = gold.monthly_dynamics(core, cn, null_safe=null_safe, ordered=False)
    two = gold.monthly_dynamics_by_join(core, cn, null_safe=null_safe)
    assert rows(one) == rows(two.select(*one.columns))
