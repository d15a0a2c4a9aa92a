"""Run the registry models in dependency order, materialised on Parquet.

Model catalogue (name -> how it is built and kept):

=============================  ===========  =====================================
model                          kept as      layout / key
=============================  ===========  =====================================
stg_<domain> (6), stg_socios   view         lazy frame + temp view
stg_empresas, stg_simples      table        partitioned by ``_competencia``
stg_estabelecimentos           table        ``uf, _competencia``; sorted by status
int_estabelecimentos           table        ``uf, _competencia``; sorted by status
int_socios                     incremental  merge on (cnpj_basico, cnpj_cpf_socio);
                                            ``_competencia``
mrt_dinamica_mensal            table        ``uf``; sorted by month
mrt_estabelecimentos_ativos    incremental  merge on cnpj; ``uf, ano_abertura``
=============================  ===========  =====================================

Tables are written as new versions (``sinks.tables``); incremental models
merge only source rows past their watermark. With ``uf`` given, the
watermark is taken within that state (so batching by state loads every
state, not just the first), and the merge touches that state's rows only.
"""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snaplake.operators import incremental as inc
from snaplake.operators import quality as dq
from snaplake.operators.snapshot import latest_snapshot
from snaplake.plans import gold, silver
from snaplake.plans.checks import RULES
from snaplake.schemas import DOMAIN_TABLES, STATUS_ACTIVE
from snaplake.session import brief_shuffles
from snaplake.sinks import tables
from snaplake.sources import bronze

log = logging.getLogger(__name__)


@dataclass
class Model:
    name: str
    kind: str  # view | table | incremental
    deps: list[str]
    partition_by: list[str] = field(default_factory=list)
    sort_by: list[str] = field(default_factory=list)
    keys: list[str] = field(default_factory=list)


MODELS: list[Model] = [
    *[Model(f"stg_{t}", "view", [f"bronze.{t}"]) for t in DOMAIN_TABLES],
    Model("stg_socios", "view", ["bronze.socios"]),
    Model("stg_empresas", "table", ["bronze.empresas"], ["_competencia"]),
    Model("stg_simples", "table", ["bronze.simples"], ["_competencia"]),
    Model("stg_estabelecimentos", "table", ["bronze.estabelecimentos"],
          ["uf", "_competencia"], ["cod_situacao_cadastral"]),
    Model("int_estabelecimentos", "table", ["stg_estabelecimentos"],
          ["uf", "_competencia"], ["cod_situacao_cadastral"]),
    Model("int_socios", "incremental", ["stg_socios", "stg_paises", "stg_qualificacoes"],
          ["_competencia"], keys=["cnpj_basico", "cnpj_cpf_socio"]),
    Model("mrt_dinamica_mensal", "table", ["int_estabelecimentos", "stg_cnaes"],
          ["uf"], ["mes_referencia"]),
    Model("mrt_estabelecimentos_ativos", "incremental",
          ["stg_estabelecimentos", "stg_empresas", "stg_simples", "stg_municipios",
           "stg_cnaes", "stg_naturezas", "stg_motivos", "stg_paises"],
          ["uf", "ano_abertura"], ["data_inicio_atividade"], keys=["cnpj"]),
]
BY_NAME = {m.name: m for m in MODELS}


class Lakehouse:
    """Bronze, silver and gold folders under one root, plus the model runs.

    Inputs are monthly full snapshots. ``snapshot="latest"`` (the default) counts
    dynamics over the latest snapshot, takes each establishment and partner from
    its own latest month, and joins companies, tax regime and labels of that
    month, so any number of loaded months gives one row per key, and loading them
    one by one or all at once gives the same. ``"as_loaded"`` joins whatever is
    loaded on the keys alone, for parity with runs that load one month.
    ``remove_inactive`` drops establishments that stopped being active from
    the active mart. Month-partitioned tables load only months they do not have
    yet; ``refresh_months`` re-stages months that were re-issued and has the
    incremental models read them again. Companies with ``hot_key_rows`` active
    establishments or more are salted in the mart's joins.
    """

    def __init__(self, spark: SparkSession, root: str, snapshot: str = "latest",
                 remove_inactive: bool = True, refresh_months: list[str] | None = None,
                 hot_key_rows: int | None = 1_000_000):
        if snapshot not in ("latest", "as_loaded"):
            raise ValueError(f"snapshot={snapshot!r}")
        self.spark = spark
        self.hot_key_rows = hot_key_rows
        self.refresh_months = list(refresh_months or [])
        self.root = root.rstrip("/")
        self.bronze_root = f"{self.root}/bronze"
        self.snapshot = snapshot
        self.remove_inactive = remove_inactive

    # ------------------------------------------------------------ inputs
    def ingest(self, landing_root: str, periods: list[str], extraction_date: str,
               tables_: list[str] | None = None, na_tokens=None) -> DataFrame:
        return bronze.ingest(self.spark, landing_root, self.bronze_root, periods,
                             extraction_date, tables_, na_tokens)

    def path(self, name: str) -> str:
        layer = "gold" if name.startswith("mrt_") else "silver"
        return f"{self.root}/{layer}/{name}"

    def table(self, name: str) -> DataFrame | None:
        """Current content of a model (views are recomputed lazily)."""
        if name.startswith("bronze."):
            return bronze.read_table(self.spark, self.bronze_root, name.split(".", 1)[1])
        m = BY_NAME[name]
        if m.kind == "view":
            return self._compute(m, None)
        return tables.read_table(self.spark, self.path(name))

    def _latest(self, name: str, df: DataFrame) -> DataFrame:
        """Latest snapshot of a model; for tables partitioned by month the
        latest month comes from the manifest (no scan)."""
        m = BY_NAME.get(name)
        if m is not None and m.kind != "view" and "_competencia" in m.partition_by:
            months = [p for p in tables.partition_values(self.spark, self.path(name),
                                                         "_competencia") if p]
            if months:
                return latest_snapshot(df, latest=months[-1])
        return latest_snapshot(df)

    def _inputs(self, m: Model) -> list[DataFrame]:
        dfs = [self.table(d) for d in m.deps]
        if self.snapshot == "latest" and m.name == "mrt_dinamica_mensal":
            dfs = [self._latest(d, df) for d, df in zip(m.deps, dfs)]
        return dfs

    # ---------------------------------------------------------- builders
    def _compute(self, m: Model, uf: str | None) -> DataFrame:
        ins = self._inputs(m)
        n = m.name
        if n.startswith("stg_"):
            return silver.stage(n[4:], ins[0])
        if n == "int_estabelecimentos":
            return silver.establishments_core(ins[0])
        if n == "mrt_dinamica_mensal":
            return gold.monthly_dynamics(ins[0], ins[1], ordered=False)
        raise KeyError(n)

    def _months_of(self, name: str, nulls: bool = False) -> list[str | None]:
        if name.startswith("bronze."):
            return bronze.months(self.spark, self.bronze_root, name.split(".", 1)[1])
        return [p for p in tables.partition_values(self.spark, self.path(name), "_competencia") if p or (nulls and p is None)]

    def _build_months(self, m: Model) -> None:
        """Month-partitioned table: stage only the months its input has and
        it lacks (plus ``self.refresh_months``, e.g. a re-issued month), and
        replace just those months' partitions."""
        have = set(self._months_of(m.name))
        available = set(self._months_of(m.deps[0]))
        todo = sorted((available - have) | (available & set(self.refresh_months)))
        if not todo:
            return
        src = self.table(m.deps[0]).where(F.col("_competencia").isin(*todo))
        if m.name.startswith("stg_"):
            df = silver.stage(m.name[4:], src)
        else:
            df = silver.establishments_core(src)
        source = BY_NAME.get(m.deps[0])
        alike = source is not None and source.kind == "table" and source.partition_by == m.partition_by
        tables.replace_partitions(df, self.path(m.name), m.partition_by, "_competencia", todo,
                                  m.sort_by, clustered=alike)

    def _incremental(self, m: Model, uf: str | None, full_refresh: bool) -> DataFrame:
        with tables.kept_rows(self.spark) as keep:
            return self._load(m, uf, full_refresh, keep)

    def _load(self, m: Model, uf: str | None, full_refresh: bool, keep: Callable) -> DataFrame:
        root = self.path(m.name)
        current = None if full_refresh else tables.read_table(self.spark, root)
        scope = {"uf": uf} if (uf is not None and "uf" in (current.columns if current else [])) else None
        if current is not None and scope is None and "_competencia" in m.partition_by:
            mark = tables.latest_value(self.spark, root, "_competencia")  # from the manifest
        else:
            mark = inc.watermark(current, scope=scope)
        ins = self._inputs(m)
        by_month = self.snapshot == "latest"
        fresh = self._fresh(ins[0], mark)
        one_month = self._one_month(m, mark)
        deletes = None
        if m.name == "int_socios":
            src = silver.partners_enriched(fresh, ins[1], ins[2], month_aware=by_month)
            settled = one_month
        else:
            est = fresh if uf is None else fresh.where(F.col("uf") == uf)
            if by_month and not one_month:  # each establishment as its latest month has it, active or not
                # Written: hot keys, keys to delete and the mart's rows all come from it.
                est = keep(inc.latest_per_key(est, m.keys), "latest")
            settled = one_month or by_month
            if self.remove_inactive:
                deletes = est.where(~F.col("cod_situacao_cadastral").eqNullSafe(STATUS_ACTIVE)) \
                    .select(*m.keys)
                if current is not None and settled:
                    deletes = keep(deletes.distinct(), "deletes")
                    est = self._without_deleted(est, deletes, m.keys, keep)
            src = gold.active_establishments(est, *ins[1:], month_aware=by_month, hot_key_rows=self.hot_key_rows)
        if current is None:
            # First load (or full refresh): the same rows a merge would keep.
            first = src if not by_month else src.distinct() if settled else inc.latest_per_key(src, m.keys)
            tables.write_version(first, root, m.partition_by, m.sort_by)
        else:
            tables.merge_into(self.spark, root, src, m.keys, m.partition_by, m.sort_by,
                              deletes=deletes, settled=settled)
        return tables.read_table(self.spark, root)

    def _one_month(self, m: Model, mark: str | None) -> bool:
        """Whether the rows of ``_fresh`` are of one month (from manifests and folders, no scan):
        then each key's rows are those of its latest month as they are."""
        name = m.deps[0]
        if name in BY_NAME and BY_NAME[name].kind == "view":
            name = BY_NAME[name].deps[0]
        months = self._months_of(name, nulls=True)
        if mark is not None:
            months = [p for p in months if p is not None and (p > mark or p in self.refresh_months)]
        return len(months) <= 1

    def _without_deleted(self, est: DataFrame, deletes: DataFrame, keys: list[str], keep: Callable) -> DataFrame:
        """``est`` without active rows of keys to delete. Those keys are looked for among the keys
        alone, so the rows have no exchange for it where there are none."""
        active = F.col("cod_situacao_cadastral") == STATUS_ACTIVE
        both = keep(deletes.join(est.where(active).select(*keys).hint("merge"), keys, "left_semi"), "deleted-active")
        return est if both.isEmpty() else est.join(both.hint("merge"), keys, "left_anti")

    def _fresh(self, source: DataFrame, mark: str | None) -> DataFrame:
        """Rows past the watermark, and those of re-issued months."""
        new = inc.since(source, mark)
        if mark is None or not self.refresh_months:
            return new
        return source.where((F.col("_competencia") > mark) | F.col("_competencia").isin(*self.refresh_months))

    def build(self, targets: list[str] | None = None, uf: str | None = None,
              full_refresh: bool = False, max_jobs: int = 4) -> list[tuple[str, str, int | None]]:
        """Build ``targets`` (default: all) in dependency order.

        Models whose inputs are ready are built side by side (up to
        ``max_jobs`` Spark jobs in flight, like the reference's thread pool).
        ``uf`` restricts the active-establishments mart to one state (its
        watermark is then taken within that state); other models ignore it.
        Returns ``(model, kind, version)`` per model built.
        """
        wanted = [m for m in MODELS if targets is None or m.name in targets]
        names = {m.name for m in wanted}
        level: dict[str, int] = {}
        for m in MODELS:  # MODELS is listed in dependency order
            level[m.name] = 1 + max((level.get(d, -1) for d in m.deps if d in names), default=-1)

        def one(m: Model):
            if m.kind == "view":
                self._compute(m, None).createOrReplaceTempView(m.name)
                version = None
            elif m.kind == "table":
                if "_competencia" in m.partition_by and not full_refresh:
                    self._build_months(m)
                else:
                    df = self._compute(m, uf)
                    tables.write_version(df, self.path(m.name), m.partition_by, m.sort_by)
                tables.publish(self.spark, m.name, self.path(m.name))
                version = tables.committed_versions(self.spark, self.path(m.name))[-1]
            else:
                self._incremental(m, uf, full_refresh).createOrReplaceTempView(m.name)
                version = tables.committed_versions(self.spark, self.path(m.name))[-1]
            log.info("built %s", m.name)
            return (m.name, m.kind, version)

        done = []
        with brief_shuffles(self.spark):
            for lv in sorted({level[m.name] for m in wanted}):
                batch = [m for m in wanted if level[m.name] == lv]
                done += bronze.run_concurrently(one, batch, max_jobs)
        return done

    def backfill(self, landing_root: str, periods: list[str], extraction_date: str,
                 targets: list[str] | None = None) -> list[tuple[str, str, int | None]]:
        """Ingest a range of months (one job per table for all of them), then
        build once; incremental models take all new months in one merge."""
        self.ingest(landing_root, periods, extraction_date)
        return self.build(targets)

    def run_by(self, values: list[str], targets: list[str] | None = None,
               build: Callable | None = None) -> tuple[list[str], list[tuple[str, str]]]:
        """Build ``targets`` (default: the active mart) once per state; a
        failing state does not stop the others. Returns (ok states,
        [(failed state, error)])."""
        targets = targets or ["mrt_estabelecimentos_ativos"]
        ok, failed = [], []
        for v in values:
            try:
                (build or self.build)(targets=targets, uf=v)
                ok.append(v)
            except Exception as e:  # noqa: BLE001 - report and continue, like the batch script
                log.error("state %s failed: %s", v, e)
                failed.append((v, str(e)))
        return ok, failed

    COUNTED = "int_estabelecimentos"

    def update_dynamics(self) -> DataFrame:
        """The dynamics of the latest snapshot, kept up by signed changes of the counts.

        The state table holds the counts per month, state and activity, and in each row the
        snapshot and table version they stand for. A new snapshot adds its events and
        subtracts those of the snapshot counted before; a re-issued one is compared with the
        version counted before, and partitions that both versions share are not read.
        The state is written whole, as one new version: it is as small as the mart, and a
        lost run leaves the old one. Returns the mart."""
        root, state_root = self.path(self.COUNTED), self.path("mrt_dinamica_contagens")
        version = tables.committed_versions(self.spark, root)[-1]
        month = self._months_of(self.COUNTED)[-1]
        state = tables.read_table(self.spark, state_root)
        known = None if state is None else state.select("contado_mes", "contado_versao").first()
        if known is not None and not tables.readable(self.spark, root, known["contado_versao"]):
            known = None  # its files were vacuumed: count afresh
        if known is None or (known["contado_mes"], known["contado_versao"]) != (month, version):
            before, after = self.changed_snapshots(known, month, version)
            kept = None if known is None else state.drop("contado_mes", "contado_versao")
            counts = gold.apply_delta(kept, gold.dynamics_delta(before, after))
            tables.write_version(counts.withColumns({"contado_mes": F.lit(month), "contado_versao": F.lit(version)}),
                                 state_root, ["uf"], ["mes_referencia"])
            state = tables.read_table(self.spark, state_root)
        labels = self._latest("stg_cnaes", self.table("stg_cnaes"))
        return gold.labelled_dynamics(state, labels).select(*gold.DYNAMICS_COLUMNS)

    def changed_snapshots(self, known, month: str, version: int) -> tuple[DataFrame | None, DataFrame]:
        """The snapshot counted before and the one to count, without the partitions they share."""
        root = self.path(self.COUNTED)
        meta = {v: tables.read_meta(self.spark, root, v) for v in ({version} if known is None else {version, known["contado_versao"]})}

        def folders(v: int, m: str) -> set[str]:
            return {rel for rel in meta[v]["manifest"] if f"_competencia={m}" in rel.split("/")}

        new = folders(version, month)
        if known is None:
            old: set[str] = set()
        else:
            old = folders(known["contado_versao"], known["contado_mes"])
            if known["contado_mes"] == month:
                same = {rel for rel in new & old if meta[version]["manifest"][rel] == meta[known["contado_versao"]]["manifest"][rel]}
                new, old = new - same, old - same
        schema = tables.read_table(self.spark, root).schema
        after = tables.read_partitions(self.spark, root, meta[version], new, schema)
        return (None if known is None else tables.read_partitions(self.spark, root, meta[known["contado_versao"]], old, schema)), after

    def build_states(self, states: list[str | None] | None = None,
                     rules: list[dq.Rule] | None = None) -> tuple[list[str | None], list[tuple[str | None, str]]]:
        """The active mart for ``states`` (default: all that staging holds) in one job and one merge.

        Every state's rows past its own watermark are built together, so companies, tax
        regime and labels are read once, not once per state. ``rules`` (default: the mart's
        declared tests) are then counted per state in one aggregate, and a state that fails
        one is held back: neither its rows nor moves into or out of it are merged, its
        partitions stay as they are, and its watermark makes the next run take it again.
        If the job itself fails, its states are halved until the ones at fault are alone.
        Returns (ok states, [(failed state, why)])."""
        m = BY_NAME["mrt_estabelecimentos_ativos"]
        if states is None:
            states = tables.partition_values(self.spark, self.path(m.deps[0]), "uf")
        rules = RULES[m.name] if rules is None else rules
        try:
            held = self._merge_states(m, states, rules)
        except Exception as e:  # noqa: BLE001 - isolate the state, like a batch that goes on
            if len(states) == 1:
                log.error("state %s failed: %s", states[0], e)
                return [], [(states[0], str(e))]
            half = len(states) // 2
            (ok, failed), (ok2, failed2) = (self.build_states(part, rules) for part in (states[:half], states[half:]))
            return ok + ok2, failed + failed2
        return [s for s in states if s not in held], sorted(held.items(), key=lambda x: x[0] or "")

    def states_batch(self, states: list[str | None]) -> tuple[DataFrame, DataFrame]:
        """(rows, latest) that ``build_states`` merges: the mart's rows past each state's
        watermark, and every establishment behind them (``cnpj``, ``uf``, whether active)."""
        return self._states_batch(states, lambda df, name: df)

    def _states_batch(self, states: list[str | None], keep: Callable) -> tuple[DataFrame, DataFrame]:
        m = BY_NAME["mrt_estabelecimentos_ativos"]
        source, *others = self._inputs(m)
        current = tables.read_table(self.spark, self.path(m.name))
        marks = inc.watermarks(current, "uf")
        known = tables.partition_values(self.spark, self.path(m.deps[0]), "uf")
        by_month = self.snapshot == "latest"
        late = {s: w for s, w in marks.items() if w < max(marks.values())} if by_month and marks else {}
        if late:
            # A state held back before: what lives there may have moved to a state that is ahead, and
            # what it has may be older than what such a state has, so each key's newest row decides.
            if all(s in marks for s in known) and not self.refresh_months:
                source = inc.since(source, min(late.values()))
            newest = inc.latest_per_key(source, m.keys)
            there = current.where(F.col("uf").isin(*[s for s in late if s is not None])).select(*m.keys).distinct()
            est = inc.since_each(newest, marks, "uf", again=self.refresh_months)
            est = est.unionByName(newest.join(there, m.keys, "left_semi")).distinct()
        else:
            est = inc.since_each(source, marks, "uf", scopes=known, again=self.refresh_months)
        named = [s for s in states if s is not None]
        wanted = F.col("uf").isin(*named) if named else F.lit(False)
        est = est.where(wanted | F.col("uf").isNull() if None in states else wanted)
        if by_month:  # hot keys, the mart's rows and what is behind them all come from it
            est = keep(inc.latest_per_key(est, m.keys), "latest")
        rows = gold.active_establishments(est, *others, month_aware=by_month, hot_key_rows=self.hot_key_rows)
        active = F.col("cod_situacao_cadastral").eqNullSafe(STATUS_ACTIVE)
        return rows, est.select("cnpj", "uf", active.alias("active"))

    def _merge_states(self, m: Model, states: list[str | None], rules: list[dq.Rule]) -> dict[str | None, str]:
        with brief_shuffles(self.spark), tables.kept_rows(self.spark) as keep:
            return self._merge_batch(m, states, rules, keep)

    def _merge_batch(self, m: Model, states: list[str | None], rules: list[dq.Rule], keep: Callable) -> dict[str | None, str]:
        rows, latest = self._states_batch(states, keep)
        rows, latest = keep(rows, "states"), keep(latest, "states-latest")
        held: dict[str | None, str] = {}
        if rules:
            failed = dq.failed(dq.check(rows, m.name, rules, by="uf")).collect()  # a row per state and rule
            for r in failed:
                why = f"{r['test_name']}({r['column_name']}): {r['failures']}"
                held[r["uf"]] = f"{held[r['uf']]}; {why}" if r["uf"] in held else why
        current = tables.read_table(self.spark, self.path(m.name))
        deletes = latest.where(~F.col("active")) if self.remove_inactive else None
        if held:
            log.error("states held back: %s", held)
            names = [s for s in held if s is not None]
            inside = F.col("uf").isin(*names) if names else F.lit(False)
            inside = F.coalesce(inside, F.lit(None in held))
            home = None if current is None else current.where(inside).select(*m.keys).distinct()

            def let_in(df: DataFrame) -> DataFrame:
                df = df.where(~inside)
                return df if home is None else df.join(home, m.keys, "left_anti")

            rows = let_in(rows)
            deletes = None if deletes is None else let_in(deletes)
        deletes = None if deletes is None else deletes.select(*m.keys)
        by_month = self.snapshot == "latest"  # then the rows are those of each key's latest month
        if current is None:
            tables.write_version(rows.distinct() if by_month else rows, self.path(m.name), m.partition_by, m.sort_by)
        else:
            if by_month and deletes is not None:
                deletes = keep(deletes.distinct(), "deletes")
                rows = self._without_deleted(rows, deletes, m.keys, keep)
            tables.merge_into(self.spark, self.path(m.name), rows, m.keys, m.partition_by, m.sort_by, deletes=deletes, settled=by_month)
        tables.publish(self.spark, m.name, self.path(m.name))
        return held

    def vacuum(self, keep: int = 2) -> list[str]:
        """Drop table files the newest ``keep`` versions no longer reference."""
        removed = []
        for m in MODELS:
            if m.kind != "view":
                removed += tables.vacuum(self.spark, self.path(m.name), keep)
        return removed

    def check_incremental(self, models: list[str] | None = None) -> DataFrame:
        """The declared data tests from summaries that are kept per partition of each table.

        Only partitions that are new, or rewritten since they were last summarised, are
        read; the report is merged from the summaries (null counts, and a count per key for
        ``unique``). Views and tables without partitions are tested as they are."""
        out = None
        for name in [m for m in RULES if models is None or m in models]:
            m = BY_NAME[name]
            if m.kind == "view" or not m.partition_by:
                report = dq.check(self.table(name), name, RULES[name])
            else:
                report = dq.merged(self._summaries(m), name, RULES[name])
            out = report if out is None else out.unionByName(report)
        return dq.with_status(out)

    def unsummarised(self, m: Model) -> tuple[dict, set[str], DataFrame | None]:
        """(newest manifest, partitions without a summary of it, the summaries kept)."""
        root, kept_root = self.path(m.name), f"{self.root}/tests/{m.name}"
        meta = tables.read_meta(self.spark, root, tables.committed_versions(self.spark, root)[-1])
        kept = tables.read_table(self.spark, kept_root)
        have = set()
        if kept is not None:  # as many rows as the table has partitions
            have = {(r["parte"], r["versao"]) for r in kept.where(F.col("rule") == dq.MARK).select("parte", "versao").collect()}
        return meta, {rel for rel, v in meta["manifest"].items() if (rel, v) not in have}, kept

    def _summaries(self, m: Model) -> DataFrame:
        root, kept_root = self.path(m.name), f"{self.root}/tests/{m.name}"
        meta, todo, kept = self.unsummarised(m)
        gone = kept is not None and {r[0] for r in kept.select("parte").distinct().collect()} - set(meta["manifest"])
        if todo or gone:
            schema = tables.read_table(self.spark, root).schema
            rows = tables.read_partitions(self.spark, root, meta, todo, schema)
            names = self.spark.createDataFrame([(rel, meta["manifest"][rel], *tables._values(rel)) for rel in sorted(todo)], ", ".join(
                ["parte string", "versao int", *(f"__p{i} string" for i in range(len(m.partition_by)))]))
            new = dq.summarise(rows, RULES[m.name], m.partition_by)
            same = F.lit(True)
            for i, c in enumerate(m.partition_by):
                same = same & F.col(f"__part_{c}").eqNullSafe(F.col(f"__p{i}"))
            new = new.join(F.broadcast(names), same).select("parte", "versao", *dq.SUMMARY_COLUMNS)
            marks = names.select("parte", "versao", F.lit(dq.MARK).alias("rule"), F.lit(None).cast("string").alias("key"), F.lit(0).cast("long").alias("n"))
            new = new.unionByName(marks)
            replaced = sorted(todo | (gone or set()))
            if kept is None:
                tables.write_version(new, kept_root, ["parte"])
            else:
                tables.replace_partitions(new, kept_root, ["parte"], "parte", replaced)
        return tables.read_table(self.spark, kept_root)

    def check(self, models: list[str] | None = None) -> DataFrame:
        """The declared data tests over the built models: one row per rule
        with its failing-row count and PASS/FAIL (lazy report)."""
        names = [m for m in RULES if models is None or m in models]
        return dq.with_status(dq.check_all({m: (self.table(m), RULES[m]) for m in names}))
