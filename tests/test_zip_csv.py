import os
import zipfile

import pytest

from snaplake.sources.landing import list_files, latest_period, periods
from snaplake.sources.zip_csv import read_zips

LINES = ['"1";"a ""q"" b";"";x', '"2";"São; Paulo";NA;y', '"3";short', '"4";a;b;c;EXTRA', "",
         '"5";"line1\nline2";NULL; sp ']


def make_zip(path, members):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with zipfile.ZipFile(path, "w") as z:
        for name, text in members:
            z.writestr(name, text.encode("latin-1"))


def rows(df):
    return sorted(tuple(r) for r in df.drop("_arquivo_origem").collect())


@pytest.mark.parametrize("parser", ["arrow", "python"])
def test_literal_fixture_default(spark, scratch, parser):
    p = f"{scratch}/F.zip"
    make_zip(p, [("F.CSV", "\r\n".join(LINES) + "\r\n"), ("other.csv", '"9";"9";"9";"9"\n')])
    got = rows(read_zips(spark, p, columns=["a", "b", "c", "d"], parser=parser))
    assert got == [("1", 'a "q" b', None, "x"), ("2", "São; Paulo", "NA", "y"),
                   ("3", "short", None, None), ("5", "line1\nline2", "NULL", " sp ")]


@pytest.mark.parametrize("parser", ["arrow", "python"])
def test_literal_fixture_pandas_tokens(spark, scratch, parser):
    p = f"{scratch}/F.zip"
    make_zip(p, [("F.CSV", "\n".join(LINES))])
    got = rows(read_zips(spark, p, columns=["a", "b", "c", "d"], na_tokens="pandas", parser=parser))
    assert ("2", "São; Paulo", None, "y") in got and ("5", "line1\nline2", None, " sp ") in got


def test_empty_zip_fails(spark, scratch):
    p = f"{scratch}/E.zip"
    make_zip(p, [])
    with pytest.raises(Exception, match="empty zip"):
        read_zips(spark, p, columns=["a"]).collect()


def test_unknown_table_fails(spark, scratch):
    with pytest.raises(ValueError):
        read_zips(spark, scratch, table="nope")


def test_shards_of_one_month_keep_every_row(spark, scratch):
    from snaplake.sources import bronze
    land = f"{scratch}/landing"
    for i in range(3):
        body = "\n".join(f'"{i}{k:07d}";"N{k}";"2062";"49";"1,0";"01";""' for k in range(50))
        make_zip(f"{land}/competencia=2026-01/Empresas{i}.zip", [(f"E{i}.CSV", body)])
    with open(f"{land}/competencia=2026-01/readme.txt", "w") as f:
        f.write("ignored")
    summary = bronze.ingest(spark, land, f"{scratch}/bronze", ["2026-01"], "2026-02-20",
                            tables=["empresas"])
    (t, comp, n_files, n_rows), = [tuple(r) for r in summary.collect()]
    assert (t, comp, n_files, n_rows) == ("empresas", "2026-01", 3, 150)
    # rerun: dynamic overwrite replaces the month, no duplicates
    summary = bronze.ingest(spark, land, f"{scratch}/bronze", ["2026-01"], "2026-02-20",
                            tables=["empresas"])
    assert [tuple(r) for r in summary.collect()][0][3] == 150


def test_listing_routing_and_periods(spark, scratch):
    land = f"{scratch}/landing"
    for per, names in [("2026-01", ["Estabelecimentos0.zip", "Cnaes.zip", "Weird.zip"]),
                       ("2026-02", ["Socios3.zip"])]:
        for n in names:
            make_zip(f"{land}/competencia={per}/{n}", [("x.csv", '"1";"2"')])
    lst = {(r["nome"], r["pasta"], r["tabela"]) for r in list_files(spark, land).collect()}
    assert lst == {("Estabelecimentos0.zip", "2026-01", "estabelecimentos"),
                   ("Cnaes.zip", "2026-01", "cnaes"), ("Weird.zip", "2026-01", "weird"),
                   ("Socios3.zip", "2026-02", "socios")}
    assert [r[0] for r in periods(spark, land).collect()] == ["2026-01", "2026-02"]
    assert latest_period(spark, land) == "2026-02"


def test_latest_period_none_raises(spark, scratch):
    os.makedirs(f"{scratch}/empty/competencia=2026-01", exist_ok=True)
    with pytest.raises(Exception):
        latest_period(spark, f"{scratch}/empty")


def test_csv_dialect_drops_long_rows(spark, scratch):
    from snaplake.sources.csv_dialect import read_csv
    with open(f"{scratch}/m.csv", "w", encoding="latin-1") as f:
        f.write('"1";"a ""b"""\n"2";"two\nlines"\n"3";a;EXTRA\n"4"\n')
    got = sorted(tuple(r)[:2] for r in read_csv(spark, f"{scratch}/m.csv", "cnaes").collect())
    assert got == [("1", 'a "b"'), ("2", "two\nlines"), ("4", None)]
