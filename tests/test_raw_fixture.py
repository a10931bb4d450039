"""Whole pipeline on a small raw fixture of our own (CSV, CSV, JSON array)
carrying the defect types listed in FIXTURES.md section 1."""

import datetime as dt
import json
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from strata.operators import audit, quality, reconcile
from strata.plans import audit_clean, gold, jobs, lenient, silver
from strata.operators.quality import DECLARED_CHECKS
from strata.sources import readers
from strata.session import scratch_path

CLIENTES = """cliente_id,nome,email,estado,data_cadastro
101,joao silva,joao@x.com,SP,2023-45-10
101,JOAO SILVA,JOAO@X.COM,São Paulo,2023-01-15
102,MARIA OLIVEIRA,,RIO DE JANEIRO,2023/02/20
103,Ana  Souza, ana@x.com ,PARANÁ,15/03/2023
104,pedro lima,NA,MG,2023-04-01 10:00:00
"""
PEDIDOS = """pedido_id,cliente_id,data_pedido,valor_total,status
7001,101,2023-06-01,"R$ 162,5",CONCLUIDO
7001,101,2023-06-01,"R$ 162,5",CONCLUIDO
7002,102,2023-06-89,"R$ 10,00",CONCLUIDO
7003,999,2023-06-05,"R$ 1.200,00",CONCLUIDO
7004,103,2023/06/11,,pendente
7005,104,2923-06-22,"R$ 5,00",CONCLUIDO
7006,101,2023-07-02,"R$ 46.284,00",concluido
7007,102,12/07/2023,"R$ 53,805",PENDEDNTE
7008,103,2023-07-15,"R$ 99,90",cancelado
"""
PAGAMENTOS = [
    {"pagamento_id": 1, "pedido_id": 7001, "metodo_pagamento": "PIX", "valor_pago": 30.0, "data_pagamento": "01/06/2023"},
    {"pagamento_id": 2, "pedido_id": 7006, "metodo_pagamento": "cartao_credito", "valor_pago": 100.5,
     "data_pagamento": "2023-07-03"},
    {"pagamento_id": 3, "pedido_id": 7006, "metodo_pagamento": "Cartão de Crédito", "valor_pago": 50,
     "data_pagamento": "03/07/2023"},
    {"pagamento_id": 4, "pedido_id": 7099, "metodo_pagamento": "Boleto", "valor_pago": 10.0,
     "data_pagamento": "05/07/2023"},
    {"pagamento_id": 5, "pedido_id": 7004, "metodo_pagamento": "pix", "valor_pago": 20.0, "data_pagamento": "10/06/2023"},
]
AS_OF = "2026-01-01"


@pytest.fixture(scope="module")
def raw(tmp_path_factory):
    d = tmp_path_factory.mktemp("raw")
    (d / "clientes.csv").write_text(CLIENTES, encoding="utf-8")
    (d / "pedidos.csv").write_text(PEDIDOS, encoding="utf-8")
    (d / "pagamentos.json").write_text(json.dumps(PAGAMENTOS, indent=4, ensure_ascii=False), encoding="utf-8")
    return str(d)


@pytest.fixture(scope="module")
def bronze(spark, raw):
    specs = [jobs.SourceSpec("clientes", f"{raw}/clientes.csv", "csv", silver.CUSTOMER_COLUMNS),
             jobs.SourceSpec("pedidos", f"{raw}/pedidos.csv", "csv", silver.ORDER_COLUMNS),
             jobs.SourceSpec("pagamentos", f"{raw}/pagamentos.json", "json", silver.PAYMENT_COLUMNS, multi_line=True)]
    root = scratch_path(spark, "bronze-fixture")
    return root, jobs.bronze_ingest(spark, specs, root)


def test_bronze_counts_and_text(spark, bronze):
    root, counts = bronze
    assert counts == {"clientes": 5, "pedidos": 9, "pagamentos": 5}
    b = spark.read.parquet(f"{root}/pedidos")
    assert all(f.dataType.simpleString() == "string" for f in b.schema.fields if f.name not in readers.FILE_ORDER)
    assert b.select(F.countDistinct("_ingerido_em")).first()[0] == 1
    c = spark.read.parquet(f"{root}/clientes")
    assert c.where("cliente_id = '104'").first()["email"] is None       # NA token -> NULL
    p = spark.read.parquet(f"{root}/pagamentos")
    assert sorted(r["valor_pago"] for r in p.collect()) == ["10.0", "100.5", "20.0", "30.0", "50"]


def _silver(spark, root, money="literal"):
    b = {n: spark.read.parquet(f"{root}/{n}") for n in ("clientes", "pedidos", "pagamentos")}
    c = silver.silver_customers(b["clientes"], as_of=AS_OF)
    o = silver.silver_orders(b["pedidos"], c, as_of=AS_OF, money_mode=money)
    p = silver.silver_payments(b["pagamentos"], o, money_mode=money)
    return b, c, o, p


def test_silver_customers(spark, bronze):
    _, c, _, _ = _silver(spark, bronze[0])
    rows = {r["cliente_id"]: r for r in c.collect()}
    assert set(rows) == {101, 102, 103, 104}
    assert (rows[101]["nome"], rows[101]["estado"], rows[101]["data_cadastro"], rows[101]["email"]) == \
        ("Joao Silva", "SP", dt.date(2023, 1, 15), "joao@x.com")
    assert (rows[102]["email"], rows[102]["estado"], rows[102]["data_cadastro"]) == \
        ("nao_informado@email.com", "RJ", dt.date(2023, 2, 20))
    assert (rows[103]["nome"], rows[103]["estado"], rows[103]["email"]) == ("Ana  Souza", "PR", "ana@x.com")


def test_silver_orders_and_payments(spark, bronze):
    _, _, o, p = _silver(spark, bronze[0])
    rows = {r["pedido_id"]: r for r in o.collect()}
    assert sorted(rows) == [7001, 7004, 7006, 7007, 7008]
    assert rows[7001]["valor_total"] == Decimal("162.50")
    assert (rows[7004]["valor_total"], rows[7004]["status"], rows[7004]["data_pedido"]) == \
        (Decimal("0.00"), "PENDENTE", dt.date(2023, 6, 11))
    assert (rows[7007]["valor_total"], rows[7007]["status"]) == (Decimal("53.81"), "PENDEDNTE")
    assert rows[7006]["status"] == "CONCLUÍDO" and rows[7008]["status"] == "CANCELADO"
    prow = {r["pagamento_id"]: r for r in p.collect()}
    assert sorted(prow) == [1, 2, 3, 5]
    assert prow[1]["valor_pago"] == Decimal("300.00")           # literal mode: 10x (reference parity)
    assert prow[3]["metodo_pagamento"] == "Cartão de Crédito" and prow[2]["metodo_pagamento"] == "Cartão de Crédito"
    assert prow[3]["data_pagamento"] == dt.date(2023, 7, 3)
    _, _, _, pa = _silver(spark, bronze[0], money="auto")
    assert {r["pagamento_id"]: r["valor_pago"] for r in pa.collect()}[1] == Decimal("30.00")


def test_gold_and_quality(spark, bronze):
    _, c, o, p = _silver(spark, bronze[0])
    rev = gold.revenue_customer_month(o, c).orderBy("mes_ano").collect()
    assert [(r["mes_ano"], r["cliente_id"], r["nome_cliente"], r["total_pedidos"], r["faturamento_total"],
             r["ticket_medio"]) for r in rev] == [
        ("2023-06", 101, "Joao Silva", 1, Decimal("162.50"), 162.5),
        ("2023-07", 101, "Joao Silva", 1, Decimal("46284.00"), 46284.0)]
    met = {(r["mes_ano"], r["metodo_pagamento"]): (r["quantidade_transacoes"], r["valor_total_processado"])
           for r in gold.payment_methods_month(p, o).collect()}
    assert met == {("2023-06", "PIX"): (1, Decimal("300.00")), ("2023-07", "Cartão de Crédito"): (2, Decimal("1055.00"))}
    tables = {"stg_clientes": c, "stg_pedidos": o, "stg_pagamentos": p,
              "faturamento_cliente_mensal": gold.revenue_customer_month(o, c),
              "resumo_metodos_pagamento": gold.payment_methods_month(p, o)}
    rep = quality.run_checks(tables, DECLARED_CHECKS).collect()
    assert len(rep) == 16
    failed = [(r["teste"], r["falhas"]) for r in rep if r["status"] != "pass"]
    assert failed == [("accepted_values", 2)]                     # CONCLUÍDO and PENDEDNTE
    assert quality.failed_errors(quality.run_checks(tables, DECLARED_CHECKS)).count() == 1


def test_audit_profile(spark, bronze):
    root = bronze[0]
    b = {n: spark.read.parquet(f"{root}/{n}") for n in ("clientes", "pedidos", "pagamentos")}
    assert audit.duplicate_keys(b["clientes"], "clientes", "cliente_id").first()["duplicadas"] == 1
    assert audit.duplicate_rows(b["pedidos"], "pedidos").first()["duplicadas"] == 1
    nulls = {(r["tabela"], r["coluna"]): r["nulos"] for r in
             audit.null_counts(b["clientes"], "clientes").unionByName(audit.null_counts(b["pedidos"], "pedidos")).collect()}
    assert nulls == {("clientes", "email"): 2, ("pedidos", "valor_total"): 1}
    ca = audit_clean.clean_customers_a(b["clientes"])
    oa = audit_clean.clean_orders_a(b["pedidos"])
    pa = audit_clean.clean_payments_a(b["pagamentos"])
    assert audit.orphan_count(oa, ca, "cliente_id", "cliente_id", "pedidos").first()["orfaos"] == 1
    assert audit.orphan_count(pa, oa, "pedido_id", "pedido_id", "pagamentos").first()["orfaos"] == 1
    st = {r["pedido_id"]: r["status"] for r in oa.collect()}
    assert st[7004] == "INDEFINIDO" and st[7006] == "CONCLUÍDO" and st[7008] == "INDEFINIDO"
    assert {r["nome"] for r in ca.collect()} >= {"Joao Silva", "Ana  Souza"}
    div = reconcile.divergences(oa, pa).collect()
    # valor_total of 'R$ ...' text coerces to 0.0, so every joined pair diverges
    assert sorted(r["pedido_id"] for r in div) == [7001, 7004, 7006, 7006]


def test_lenient_profile(spark, bronze):
    root = bronze[0]
    b = {n: spark.read.parquet(f"{root}/{n}") for n in ("clientes", "pedidos", "pagamentos")}
    c = lenient.silver_customers_lenient(b["clientes"])
    o = lenient.silver_orders_lenient(b["pedidos"])
    g = lenient.revenue_lenient(o, c).collect()
    months = sorted((r["cliente_id"], r["mes"]) for r in g)
    # 7002 (day 89), 7005 (year 2923) and 7004 (slashes) have no valid date
    assert (102, "NaT") in months and (104, "NaT") in months
    assert all(r["faturamento_total"] == 0.0 for r in g)            # "R$ ..." text -> 0.0
    assert any(r["cliente_id"] == 999 and r["nome"] is None for r in g)
    assert {r["cliente_id"]: r["nome"] for r in c.collect()}[101] == "joao silva"   # first in file order


def test_single_scan_profile_matches_separate_checks(spark, bronze):
    root = bronze[0]
    b = {n: spark.read.parquet(f"{root}/{n}") for n in ("clientes", "pedidos")}
    keys = {"clientes": "cliente_id", "pedidos": "pedido_id"}
    for t, df in b.items():
        prof = {(r["secao"], r["coluna"]): r["valor"] for r in audit.table_profile(df, t, keys[t]).collect()}
        sep = {("nulos", r["coluna"]): r["nulos"] for r in audit.null_counts(df, t).collect()}
        sep[("chaves_duplicadas", keys[t])] = audit.duplicate_keys(df, t, keys[t]).first()["duplicadas"]
        sep[("linhas_duplicadas", None)] = audit.duplicate_rows(df, t).first()["duplicadas"]
        assert prof == sep


def test_reconcile_per_order_sums_payments(spark):
    orders = spark.createDataFrame([(1, 100.0), (2, 50.0), (3, 10.0)], "pedido_id long, valor_total double")
    pays = spark.createDataFrame([(1, 60.0), (1, 40.0), (2, 20.0), (None, 5.0)], "pedido_id long, valor_pago double")
    per_pair = {(r["pedido_id"], r["valor_pago"]) for r in reconcile.divergences(orders, pays).collect()}
    assert per_pair == {(1, 60.0), (1, 40.0), (2, 20.0)}
    per_order = {r["pedido_id"]: r["diferenca"] for r in reconcile.divergences(orders, pays, per_order=True).collect()}
    assert per_order == {2: 30.0}                     # order 1 is fully paid once payments are summed
    nulls = reconcile.reconcile_join(orders.union(spark.createDataFrame([(None, 7.0)], orders.schema)), pays,
                                     null_safe=True)
    assert nulls.where("pedido_id IS NULL").count() == 1


def test_json_array_without_the_option_raises(spark, raw):
    spec = jobs.SourceSpec("pagamentos", f"{raw}/pagamentos.json", "json", silver.PAYMENT_COLUMNS)
    with pytest.raises(Exception, match="(?i)malformed"):
        jobs.bronze_ingest(spark, [spec], scratch_path(spark, "bronze-bad"))


def test_csv_dialect(spark, tmp_path):
    (tmp_path / "a.csv").write_text('nome,cliente_id,email\n"Ana ""Bia"" Lima\nFilha",1,N/A\n"x, y",2,nan\nz,3,NULL\n', encoding="utf-8")
    got = readers.read_csv_text(spark, str(tmp_path), ["cliente_id", "nome", "email"], multi_line=True).collect()
    assert sorted(tuple(r) for r in got) == [("1", 'Ana "Bia" Lima\nFilha', None), ("2", "x, y", None), ("3", "z", None)]
    with pytest.raises(Exception, match="(?i)column|missing"):
        readers.read_csv_text(spark, str(tmp_path), ["cliente_id", "estado"]).collect()
    (tmp_path / "b.csv").write_text("cliente_id,nome,email\n4,w,v\n", encoding="utf-8")
    with pytest.raises(Exception, match="(?i)header"):
        readers.read_csv_text(spark, str(tmp_path), ["cliente_id", "nome", "email"]).collect()


def test_first_row_follows_file_order_not_split_size(spark, tmp_path):
    (tmp_path / "part-1.csv").write_text("k,v\n7,small\n", encoding="utf-8")
    (tmp_path / "part-2.csv").write_text("k,v\n7,large\n" + "".join(f"{i},x\n" for i in range(100, 60_000)), encoding="utf-8")
    root = scratch_path(spark, "file-order")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        jobs.bronze_ingest(spark, [jobs.SourceSpec("t", str(tmp_path), "csv", ("k", "v"))], root)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    b = spark.read.parquet(f"{root}/t")
    assert b.select("_arquivo", "_bloco").distinct().count() > 3
    from strata.operators import dedup
    assert dedup.first_by_key(b, "k", jobs.file_order(b)).where("k = '7'").first()["v"] == "small"


def test_gold_rebuild_loses_a_month(spark):
    from strata.sources import sinks
    path = scratch_path(spark, "rebuild")
    both = spark.createDataFrame([("2023-06", 1), ("2023-07", 2)], "mes_ano string, v int")
    sinks.write_layer(both, path, partition_by=["mes_ano"])
    sinks.write_layer(both.where("v = 2").withColumn("v", F.lit(3)), path, partition_by=["mes_ano"])
    assert [tuple(r) for r in spark.read.parquet(path).collect()] == [(3, "2023-07")]
    sinks.write_layer(both.where("v = 1"), path, partition_by=["mes_ano"], keep_other_partitions=True)
    assert spark.read.parquet(path).count() == 2


def test_average_is_rounded_once(spark):
    orders = spark.range(20_000).select(
        F.col("id").alias("pedido_id"), F.lit(1).alias("cliente_id"), F.lit("2023-06-01").cast("date").alias("data_pedido"),
        F.when(F.col("id") < 99, F.lit("2.00")).otherwise(F.when(F.col("id") == 99, F.lit("1.99")).otherwise(F.lit("1.00")))
        .cast("decimal(10,2)").alias("valor_total"), F.lit("CONCLUÍDO").alias("status"))
    c = spark.createDataFrame([(1, "n", "e", "SP")], "cliente_id int, nome string, email string, estado string")
    row = gold.revenue_customer_month(orders, c).first()
    assert (row["faturamento_total"], row["ticket_medio"]) == (Decimal("20099.99"), 1.0)


def test_strict_ids(spark):
    from strata.functions.numbers import to_int_strict
    df = spark.createDataFrame([("101.0",), ("101.5",), ("1e2",), (" 7 ",), (None,)], "c string")
    assert [r[0] for r in df.select(to_int_strict("c")).collect()] == [101, 102, 100, 7, None]
    with pytest.raises(Exception, match="not an integer: x"):
        spark.createDataFrame([("x",)], "c string").select(to_int_strict("c")).collect()


def test_json_array_files_grow_with_the_rows(spark, tmp_path):
    import glob
    import json

    from strata.plans.catalog import write_raw_json_arrays
    path = str(tmp_path / "arrays")
    write_raw_json_arrays(spark.range(0, 500, 1, 2), path, rows_per_file=25)
    files = []
    for name in glob.glob(f"{path}/part-*"):
        with open(name) as f:
            text = f.read()
        if text:
            files.append([r["id"] for r in json.loads(text)])
    assert len(files) == 20 and max(map(len, files)) <= 25
    assert sorted(i for ids in files for i in ids) == list(range(500))


def test_json_arrays_are_landed_without_a_shuffle(spark, tmp_path):
    from strata.plans.catalog import write_raw_json_arrays
    rows = spark.createDataFrame([(i, None if i % 7 == 0 else f'"{i}", é\n]') for i in range(200)], "id int, t string").coalesce(3)
    path = str(tmp_path / "arrays.json")
    sc = spark.sparkContext
    sc.setJobGroup("arrays", "arrays")
    try:
        write_raw_json_arrays(rows, path, rows_per_file=9, compression="gzip")
    finally:
        sc._jsc.clearJobGroup()
    tracker = sc.statusTracker()
    assert [len(tracker.getJobInfo(j).stageIds) for j in tracker.getJobIdsForGroup("arrays")] == [1]
    got = readers.read_source(spark, path, None, ["id", "t"], multi_line=True)
    assert sorted((int(r.id), r.t) for r in got.collect()) == [tuple(r) for r in rows.orderBy("id").collect()]


def test_rows_landed_in_order_are_sorted_in_as_many_tasks_as_they_need(spark, sf_small, monkeypatch):
    from strata.plans import catalog
    landed = []  # paths
    write = catalog.write_raw_csv
    monkeypatch.setattr(catalog, "ROWS_PER_SORT", 250, raising=False)
    monkeypatch.setattr(catalog, "write_raw_csv", lambda df, path, **more: (landed.append(path), write(df, path, **more)))
    got = catalog.dedup_first_file_order(spark, sf_small)
    sizes = [r["count"] for r in spark.read.option("header", True).csv(landed[0]).groupBy(F.input_file_name()).count().collect()]
    assert sum(sizes) > 5000 and len(sizes) >= sum(sizes) / 500 and max(sizes) < 1000
    assert got.count() == got.select("pagamento_id").distinct().count()


def test_block_order_is_file_order_without_paths(spark, tmp_path):
    from strata.operators import dedup
    from strata.sources import sinks
    for k in range(3):
        spark.range(k * 40, k * 40 + 40, 1, 1).selectExpr("cast(id % 50 as string) k", "cast(id as string) v") \
            .write.option("header", True).csv(str(tmp_path / "raw" / f"f{k}"))
    raw = spark.read.option("recursiveFileLookup", True).option("header", True).csv(str(tmp_path / "raw"))
    sinks.write_layer(readers.with_file_order(raw), str(tmp_path / "bronze"))
    bronze = spark.read.parquet(str(tmp_path / "bronze"))
    short = readers.with_block_order(bronze)
    assert "_arquivo" not in short.columns and short.count() == 120
    first = {r.k: r.v for r in dedup.first_by_key(short, "k", readers.BLOCK_ORDER).collect()}
    assert first == {r.k: r.v for r in dedup.first_by_key(bronze, "k", readers.FILE_ORDER).collect()}
    assert first == {str(i): str(i) for i in range(50)}
