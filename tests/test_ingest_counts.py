"""Counts observed while bronze is written, and the lines it does not take."""

import os
import zipfile

import pytest

from snaplake.sources import bronze, csv_dialect
from snaplake.sources.landing import list_files
from snaplake.sources.zip_csv import read_zips

WIDTH = 7
GOOD = ";".join(f'"{c}"' for c in "abcdefg")
LONG = GOOD + ';"";'
QUOTED = '"1";"line\none";"x;y";"";"";"";"";"too";"long"'
SHORT = '"1";"2"'


def make_zip(path, lines, end="\r\n"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("E.CSV", (end.join(lines) + end).encode("latin-1"))


def land(scratch):
    root = f"{scratch}/landing"
    make_zip(f"{root}/competencia=2026-01/Empresas0.zip", [GOOD] * 5 + [LONG, "", SHORT, QUOTED, GOOD])
    make_zip(f"{root}/competencia=2026-01/Empresas1.zip", [GOOD] * 3, end="\n")
    make_zip(f"{root}/competencia=2026-02/Empresas0.zip", [LONG])
    return root


def test_report_per_zip_and_rejected_lines(spark, scratch):
    root, out = land(scratch), f"{scratch}/bronze"
    report = sorted(tuple(r) for r in bronze.ingest_report(spark, root, out, ["2026-01", "2026-02"], "2026-02-20", ["empresas", "socios"]).collect())
    assert report == [("empresas", "2026-01", "Empresas0.zip", 7, 1, 2), ("empresas", "2026-01", "Empresas1.zip", 3, 0, 0),
                      ("empresas", "2026-02", "Empresas0.zip", 0, 0, 1)]
    assert bronze.read_table(spark, out, "empresas").count() == 10
    lines = sorted(tuple(r) for r in bronze.read_rejects(spark, out).collect())
    assert lines == [("empresas", "2026-01", "Empresas0.zip", QUOTED, 9), ("empresas", "2026-01", "Empresas0.zip", LONG, 9),
                     ("empresas", "2026-02", "Empresas0.zip", LONG, 9)]
    # a re-issued month takes its own rejected lines back, and no others
    make_zip(f"{root}/competencia=2026-01/Empresas0.zip", [GOOD])
    bronze.ingest_report(spark, root, out, ["2026-01"], "2026-02-20", ["empresas"])
    assert [r.competencia for r in bronze.read_rejects(spark, out).collect()] == ["2026-02"]


def test_bronze_is_not_read_for_the_report(spark, scratch, monkeypatch):
    root = land(scratch)
    monkeypatch.setattr(bronze, "read_table", lambda *a, **k: pytest.fail("bronze read again"))
    assert bronze.ingest(spark, root, f"{scratch}/bronze", ["2026-01"], "2026-02-20", ["empresas"]).first()["n_rows"] == 10


def test_no_rejects_no_table(spark, scratch):
    make_zip(f"{scratch}/l/competencia=2026-01/Cnaes.zip", ['"1";"a"'])
    bronze.ingest_report(spark, f"{scratch}/l", f"{scratch}/b", ["2026-01"], "2026-02-20", ["cnaes"])
    assert bronze.read_rejects(spark, f"{scratch}/b").count() == 0


@pytest.mark.parametrize("parser", ["arrow", "python"])
def test_counts_and_rejects_of_the_source(spark, scratch, parser):
    path = f"{scratch}/F.zip"
    make_zip(path, [GOOD, LONG, SHORT, QUOTED])
    df = read_zips(spark, path, table="empresas", parser=parser, counts=True)
    last = df.where("_contagem IS NOT NULL").collect()
    assert [tuple(r._contagem) for r in last] == [(2, 1, 2)] and df.count() == 3
    got = [tuple(r) for r in read_zips(spark, path, table="empresas", parser=parser, rejects=True).collect()]
    assert got == [("F.zip", LONG, 9), ("F.zip", QUOTED, 9)]
    assert read_zips(spark, path, table="empresas", parser=parser).count() == 2


def test_plain_csv_counts_fields(spark, scratch):
    os.makedirs(f"{scratch}/csv")
    with open(f"{scratch}/csv/E.CSV", "w", encoding="latin-1") as f:
        f.write("\n".join([GOOD, LONG, SHORT, QUOTED, GOOD + ";", '"1";"a ""q"" b;";"";"";"";"";"é"']) + "\n")
    df = csv_dialect.read_csv(spark, f"{scratch}/csv", "empresas")
    rows = sorted(tuple(r)[:2] + (r._arquivo_origem,) for r in df.collect())
    assert rows == [("1", "2", "E.CSV"), ("1", 'a "q" b;', "E.CSV"), ("a", "b", "E.CSV")]
    assert df.select("cnpj_basico").count() == 3  # fewer columns read, the same rows
    assert sorted(r.n_campos for r in csv_dialect.read_rejects(spark, f"{scratch}/csv", "empresas").collect()) == [8, 9, 9]
    assert csv_dialect.read_csv(spark, f"{scratch}/csv", "empresas", drop_long_rows=False).count() == 6


def test_listed_sizes_are_the_files_sizes(spark, scratch):
    root = land(scratch)
    for r in list_files(spark, root).collect():
        assert r.size_bytes == os.path.getsize(f"{root}/competencia={r.pasta}/{r.nome}")
