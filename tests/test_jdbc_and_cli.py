"""JDBC reader option logic (with a recording fake, no database) and the
command line end to end in its own process."""

import json
import os
import subprocess
import sys

import duckdb

from martforge.sources import jdbc as J


class _Reader:
    def __init__(self, log, bounds):
        self.log, self.bounds, self.opts = log, bounds, {}

    def format(self, f):
        self.opts["format"] = f
        return self

    def options(self, **kw):
        self.opts.update(kw)
        return self

    def option(self, k, v):
        self.opts[k] = v
        return self

    def load(self):
        self.log.append(dict(self.opts))
        return _Frame(self.bounds)

    def jdbc(self, url, table, predicates, properties):
        self.log.append({"url": url, "dbtable": table, "predicates": predicates, **properties})
        return _Frame(self.bounds)


class _Frame:
    def __init__(self, bounds):
        self.bounds = bounds

    def first(self):
        return {"lo": self.bounds[0], "hi": self.bounds[1]}

    def collect(self):
        return [{"lo": b} for b in self.bounds if b is not None]


class _Spark:
    def __init__(self, bounds=(1, 1000)):
        self.log = []
        self.bounds = bounds

        class _SC:
            defaultParallelism = 4
        self.sparkContext = _SC()

    @property
    def read(self):
        return _Reader(self.log, self.bounds)


def test_partitioned_tables_are_read_in_slices():
    spark = _Spark(bounds=(10, 5000))
    J.jdbc_sources(spark, "jdbc:postgresql://db/x", {"user": "u"}, num_partitions=8)
    loads = [o for o in spark.log if "partitionColumn" in o]
    tables = {o["dbtable"]: o for o in loads}
    assert set(tables) == {"vendas.nota_fiscal", "vendas.item_nota_fiscal", "geral.endereco", "vendas.produto",
                           "geral.pessoa_fisica", "geral.pessoa_juridica"}
    o = tables["vendas.item_nota_fiscal"]
    assert (o["partitionColumn"], o["lowerBound"], o["upperBound"], o["numPartitions"]) == (
        "id_nota_fiscal", "10", "5001", "8")
    assert o["user"] == "u" and o["fetchsize"] == "10000"
    small = [o for o in spark.log if o.get("dbtable") == "geral.estado"]
    assert small and "partitionColumn" not in small[0]


def test_quantile_slices_hold_equally_many_rows_of_gapped_keys():
    db = duckdb.connect()
    # Dense ids, a gap of 10^9, few ids far apart, one hot id, and null.
    db.execute("CREATE TABLE t AS SELECT range AS id FROM range(4000) UNION ALL SELECT 1000000000 + range * 1000 FROM range(4000)"
               " UNION ALL SELECT 77 FROM range(3000) UNION ALL SELECT NULL FROM range(5)")
    lows = [r[0] for r in db.execute(J.quantile_query("id", "t", 8)).fetchall()]
    cuts = J.quantile_predicates("id", lows)
    sizes = [db.execute(f"SELECT count(*) FROM t WHERE {c}").fetchone()[0] for c in cuts]
    assert sum(sizes) == 11_005  # each row in one slice
    assert 6 <= len(cuts) <= 8 and max(sizes) <= 3000 + 2 * 11_000 // 8  # only the hot id is larger
    assert J.quantile_predicates("id", []) == J.quantile_predicates("id", [5, 5]) == []


def test_quantile_slices_are_read_by_predicates():
    spark = _Spark(bounds=(40, 1, 900, 40))
    J.jdbc_sources(spark, "jdbc:x", {"user": "u"}, num_partitions=4, by_quantiles=True)
    read = {o["dbtable"]: o for o in spark.log if "predicates" in o}
    assert len(read) == 6
    o = read["vendas.nota_fiscal"]
    assert o["predicates"] == ["id < 40 OR id IS NULL", "id >= 40 AND id < 900", "id >= 900"]
    assert (o["user"], o["fetchsize"]) == ("u", "10000")
    empty = _Spark(bounds=(None,))
    J.read_jdbc(empty, "jdbc:x", dbtable="t", partition_column="id", by_quantiles=True)
    assert empty.log[-1]["dbtable"] == "t" and "predicates" not in empty.log[-1]


def test_empty_partitioned_table_falls_back_to_one_read():
    spark = _Spark(bounds=(None, None))
    J.read_jdbc(spark, "jdbc:x", dbtable="t", partition_column="id")
    assert spark.log[-1]["dbtable"] == "t" and "partitionColumn" not in spark.log[-1]


class _Write:
    """Records a chained DataFrame write."""

    def __init__(self, log, rows=None):
        self.log, self.seen, self.write, self.dtypes = log, {"partitions": rows}, self, []

    def select(self, *_):
        return self

    @property
    def schema(self):
        class S:
            fields = ()
        return S

    def repartition(self, n):
        self.seen["partitions"] = n
        return self

    def format(self, f):
        self.seen["format"] = f
        return self

    def mode(self, m):
        self.seen["mode"] = m
        return self

    def option(self, k, v):
        self.seen[k] = v
        return self

    def save(self):
        self.log.append(dict(self.seen))


def test_marts_are_delivered_to_the_database():
    """Fakes only: no database may run here."""
    from martforge.plans.pipeline import deliver_marts

    log = []

    class Run:
        def table(self, _, name):
            return _Write(log)

    assert deliver_marts(None, Run(), "jdbc:postgresql://db/x", properties={"user": "u"}, num_partitions=3) == {
        "vendas_ano_mes": "overwrite", "vendas_localidade": "overwrite"}
    assert [(w["format"], w["mode"], w["dbtable"], w["truncate"], w["partitions"], w["user"]) for w in log] == [
        ("jdbc", "overwrite", t, "true", 3, "u") for t in ("vendas_ano_mes", "vendas_localidade")]


def test_command_line_run_and_report(sf_dir, tmp_path):
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = {**os.environ, "PYTHONPATH": repo}
    root = str(tmp_path / "sales")
    run = subprocess.run([sys.executable, "-m", "martforge", "run", "--sf-dir", sf_dir,
                          "--root", root, "--ds", "1998-06-15"],
                         cwd=repo, env=env, capture_output=True, text=True, timeout=600)
    assert run.returncode == 0, run.stderr[-2000:]
    out = json.loads([ln for ln in run.stdout.splitlines() if ln.startswith("{")][-1])
    assert out["counts"]["vendas_ano_mes"] > 0 and out["lake"]
    assert out["metrics"]["sem_calendario"] == 0 and "pct_atingimento_fora" in out["metrics"]
    rep = subprocess.run([sys.executable, "-m", "martforge", "report", "--root", root],
                         cwd=repo, env=env, capture_output=True, text=True, timeout=600)
    assert rep.returncode == 0, rep.stderr[-2000:]
    assert "== kpi_cards" in rep.stdout and "R$ " in rep.stdout
