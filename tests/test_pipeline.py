"""Workbooks, layer files, catalog tables and the three jobs, end to end."""

from datetime import datetime
from decimal import Decimal
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from xlsx import Date, write_workbook

from saleslake.__main__ import main
from saleslake.operators.contract import ContractError, contract_report, header_names
from saleslake.plans.bronze import bronze_build
from saleslake.plans.jobs import run_bronze, run_gold, run_silver
from saleslake.schemas import BRONZE_STORED, GOLD, RAW, RAW_REQUIRED, SILVER, SILVER_STORED, UNIT
from saleslake.sources.layers import read_any_layer, read_layer, write_layer
from saleslake.sources.rates_file import load_rates, off_calendar, read_rates
from saleslake.sources.staging import CHECKPOINT_DIR, Staging, shared_dir, stage
from saleslake.sources.tables import (
    create_database,
    preview,
    register_rates_table,
    register_table,
    repair_partitions,
)
from saleslake.sources.workbooks import list_workbooks, read_workbooks

HEADER = [f" {c.lower()} " if i % 2 else c for i, c in enumerate(RAW_REQUIRED)]


def line(fecha, ticket, article, quantity, price=100.0, cost=70.0, name="pan"):
    values = dict.fromkeys(RAW_REQUIRED, 1) | {
        "FECHA": fecha,
        "NUMERO_TICKET": ticket,
        "ID_ARTICULO": article,
        "DESC_ARTICULO": name,
        "CANTIDAD_VENDIDA": quantity,
        "VALOR_ARTICULO": price,
        "COSTO_ARTICULO": cost,
    }
    return [values[c] for c in RAW_REQUIRED]


JANUARY_5 = Date(45296)


@pytest.fixture(scope="module")
def raw_root(tmp_path_factory):
    root = tmp_path_factory.mktemp("raw")
    (root / "2024").mkdir()
    write_workbook(
        root / "Ventas_Norte.xlsx",
        {
            "enero": [
                HEADER,
                line(JANUARY_5, 1, 7, 2, name=" pan\t"),
                line(JANUARY_5, 1, 7, 9, name="doble"),
                line("2024-01-06", 2, 8, 1, name=None),
                line("sin fecha", 3, 8, 1),
            ],
            "febrero": [HEADER, line(Date(45323.4375), 4, 7, "3"), line("2024-02-02", 5, 7, -1)],
        },
    )
    write_workbook(
        root / "2024" / "VENTAS - San Juan.XLSX",
        {"hoja": [[*HEADER, "obs"], [*line("2024-01-07", 1, 9, 4), "nota"]], "vacia": [HEADER]},
        inline=True,
    )
    write_workbook(root / "Ventas_Sin Costo.xlsx", {"h": [HEADER[:-1], line(JANUARY_5, 1, 1, 1)[:-1]]})
    write_workbook(root / "Ventas_Doble.xlsx", {"h": [["FECHA", " fecha "], [1, 2]]})
    write_workbook(root / "Ventas.xlsx", {"h": [HEADER, line(JANUARY_5, 1, 1, 1)]})
    cut = {"h": [HEADER, line(JANUARY_5, 1, 1, 1), line(JANUARY_5, 2, 1, 1)]}
    write_workbook(root / "Ventas_Cortada.xlsx", cut, cut=60)
    (root / "Ventas_Rota.xlsx").write_bytes(b"no workbook")
    (root / "notas.txt").write_text("x")
    return str(root)


@pytest.fixture(scope="module")
def rates_csv(tmp_path_factory):
    path = tmp_path_factory.mktemp("rates") / "rates.csv"
    path.write_text(" Year, MONTH ,Exchange_Rate_ARS_USD\n2024,1,800\n2024,1,900\n2024,2,\n")
    return str(path)


def test_workbooks_are_found_in_any_case(spark, raw_root):
    assert list_workbooks(spark, raw_root).count() == 7


def test_workbook_cells(spark, raw_root):
    rows = read_workbooks(spark, raw_root).where("path like '%Norte%' and row_no > 1")
    first, *_ = rows.where("sheet = 'enero'").orderBy("row_no").collect()
    cells = dict(zip(RAW_REQUIRED, first.cells, strict=True))
    assert (first.row_no, first.sheet_no, first.header) == (2, 0, HEADER)
    assert cells["FECHA"] == "2024-01-05 00:00:00"
    assert (cells["DESC_ARTICULO"], cells["CANTIDAD_VENDIDA"], cells["VALOR_ARTICULO"]) == (" pan\t", "2", "100")
    moment = rows.where("sheet = 'febrero'").orderBy("row_no").first().cells[0]
    assert moment == "2024-02-01 10:30:00"


def test_header_names(spark):
    headers = [[" fecha ", "X", "X", "x", None, None, "X.1"], [], None, ["a\t", "\u00a0Ñu"]]
    df = spark.createDataFrame([(h,) for h in headers], "header array<string>")
    got = [r[0] for r in df.select(header_names(F.col("header"))).collect()]
    assert got == [["FECHA", "X", "X.1", "X", "UNNAMED: 4", "UNNAMED: 5", "X.1"], [], None, ["A", "ÑU"]]


def test_contract_of_units(spark, raw_root):
    units = contract_report(read_workbooks(spark, raw_root), RAW_REQUIRED).collect()
    got = {(r.path.split("/")[-1], r.sheet): (r.row_count, r.missing, r.unexpected, r.error, r.accepted) for r in units}
    assert got["Ventas_Norte.xlsx", "enero"] == (5, "", "", None, True)
    assert got["VENTAS - San Juan.XLSX", "hoja"] == (2, "", "OBS", None, True)
    assert got["Ventas_Sin Costo.xlsx", "h"] == (2, "COSTO_ARTICULO", "", None, False)
    assert got["Ventas_Doble.xlsx", "h"][4] is False
    assert got["Ventas_Rota.xlsx", None] == (1, None, None, "unreadable_workbook: BadZipFile", False)
    assert got["Ventas_Cortada.xlsx", "h"][3:] == ("unreadable_sheet: ParseError", False)


def test_bronze_of_workbooks(spark, raw_root):
    bronze = bronze_build(read_workbooks(spark, raw_root).where("path not like '%Cortada%'"))
    got = {(r.SUCURSAL, r.MONTH, r.NUMERO_TICKET, r.DESC_ARTICULO) for r in bronze.collect()}
    assert got == {
        ("Norte", 1, "1", "pan"),
        ("Norte", 1, "1", "doble"),
        ("Norte", 1, "2", "nan"),
        ("Norte", 2, "4", "pan"),
        ("Norte", 2, "5", "pan"),
        ("SanJuan", 1, "1", "pan"),
    }
    extra = bronze.where("SUCURSAL = 'SanJuan'").first()
    assert extra._extra == {"OBS": "nota"} and extra.FECHA == datetime(2024, 1, 7)


def test_three_jobs(spark, raw_root, rates_csv, tmp_path):
    bronze_root, silver_root, gold_root = (str(tmp_path / n) for n in ("bronze", "silver", "gold"))
    audit = {(r.path.split("/")[-1], r.sheet): r for r in run_bronze(spark, raw_root, bronze_root).collect()}
    ok = audit["Ventas_Norte.xlsx", "enero"]
    assert (ok.status, ok.data_rows, ok.bad_dates) == ("ok", 4, 1)
    assert audit["VENTAS - San Juan.XLSX", "vacia"].status == "ok" and ok.unexpected is None
    assert audit["VENTAS - San Juan.XLSX", "hoja"].unexpected == "OBS"
    assert len({r.run_id for r in audit.values()}) == 1 and ok.run_at is not None
    assert audit["Ventas_Sin Costo.xlsx", "h"].reason == "missing_columns: COSTO_ARTICULO"
    assert audit["Ventas_Doble.xlsx", "h"].reason == "duplicate_columns"
    assert audit["Ventas.xlsx", "h"].reason == "empty_branch"
    cut = audit["Ventas_Cortada.xlsx", "h"]
    assert (cut.reason, cut.data_rows) == ("unreadable_sheet: ParseError", 1)
    assert audit["Ventas_Rota.xlsx", None].reason == "unreadable_workbook: BadZipFile"

    audit = {(r.SUCURSAL, r.MONTH): r for r in run_silver(spark, bronze_root, rates_csv, silver_root).collect()}
    assert {k: (r.rows_in, r.rows_out, r.status) for k, r in audit.items()} == {
        ("Norte", 1): (3, 2, "ok"),
        ("Norte", 2): (2, 1, "ok"),
        ("SanJuan", 1): (1, 1, "ok"),
    }
    silver = read_layer(spark, silver_root, SILVER)
    first = silver.where("SUCURSAL = 'Norte' and NUMERO_TICKET = 1").first()
    assert (first.DESC_ARTICULO, first.CANTIDAD_VENDIDA) == ("pan", 2)
    assert (first.VENTA_ARS, first.TIPO_CAMBIO, first.VENTA_USD) == (200.0, 800.0, 0.25)
    assert (first.DIA_MES, first.DIA_SEMANA) == (5, "Viernes")

    audit = run_gold(spark, silver_root, gold_root, "partition").collect()
    assert {r.status for r in audit} == {"ok"}
    gold = read_layer(spark, gold_root, GOLD)
    january = gold.where("SUCURSAL = 'Norte' and MONTH = 1").orderBy("ID_ARTICULO").collect()
    assert [(r.ID_ARTICULO, r.MARGEN_PORC_USD, r.CUMPLIMIENTO_OBJETIVO) for r in january] == [
        (7, pytest.approx(0.3), "superó"),
        (8, pytest.approx(0.3), "superó"),
    ]
    assert january[0].PRODUCTO_TOP_MARGEN == "pan" and january[0].DIA_MES_TOP_VENTAS == 5
    assert january[0].CORRELACION_SEMANAL is None or january[0].CORRELACION_SEMANAL == 1.0
    february = gold.where("MONTH = 2").first()
    assert (february.VENTA_USD, february.CUMPLIMIENTO_OBJETIVO) == (0.0, "no alcanzó")
    totals = "sum(VENTA_ARS) as v"
    assert gold.groupBy(*UNIT).agg(F.expr(totals)).exceptAll(
        silver.groupBy(*UNIT).agg(F.expr(totals))
    ).count() == 0


def test_unit_without_output_is_reported(spark, rates_csv, tmp_path):
    bronze_root, silver_root = str(tmp_path / "bronze"), str(tmp_path / "silver")

    def raw(quantity):
        cells = dict.fromkeys(RAW_REQUIRED, "1") | {"FECHA": "2024-01-05", "CANTIDAD_VENDIDA": quantity}
        return spark.createDataFrame([("Ventas_A.xlsx", "h", 0, 2, None, HEADER, list(cells.values()))], RAW)

    write_layer(bronze_build(raw("1")), bronze_root)
    first = run_silver(spark, bronze_root, rates_csv, silver_root, run_id="first").first()
    assert (first.status, first.run_id) == ("ok", "first")
    write_layer(bronze_build(raw("-1")), bronze_root)
    row = run_silver(spark, bronze_root, rates_csv, silver_root).first()
    assert (row.status, row.rows_out, row.reason) == ("empty", 0, "no_output_rows")
    assert row.run_id != "first" and row.run_at > first.run_at


def bronze_row(spark, branch, month, quantity="1"):
    data = dict.fromkeys(RAW_REQUIRED, "1") | {"CANTIDAD_VENDIDA": quantity}
    row = spark.createDataFrame([tuple(data.values())], RAW_REQUIRED)
    return row.withColumns(
        {
            "FECHA": F.lit(f"2024-{month:02}-05").cast("timestamp"),
            "_src_file": F.lit("f"),
            "_src_sheet_no": F.lit(0),
            "_src_row": F.lit(2).cast("bigint"),
            "_extra": F.lit(None).cast("map<string,string>"),
            "SUCURSAL": F.lit(branch),
            "YEAR": F.lit(2024),
            "MONTH": F.lit(month),
        }
    )


def test_partitions_keep_text_and_are_replaced_one_by_one(spark, tmp_path):
    root = str(tmp_path / "layer")
    write_layer(bronze_row(spark, "007", 1).unionByName(bronze_row(spark, "007", 2)), root)
    write_layer(bronze_row(spark, "007", 2, "5"), root)
    rows = read_layer(spark, root, BRONZE_STORED).collect()
    assert {(r.SUCURSAL, r.YEAR, r.MONTH, r.CANTIDAD_VENDIDA) for r in rows} == {
        ("007", 2024, 1, "1"),
        ("007", 2024, 2, "5"),
    }
    (tmp_path / "layer/sucursal=007/year=2024/month=1").rename(
        tmp_path / "layer/sucursal=007/year=2024/month=01"
    )
    assert {r.MONTH for r in read_layer(spark, root, BRONZE_STORED).collect()} == {1, 2}
    assert "snappy" in {p.name.split(".")[-2] for p in (tmp_path / "layer").rglob("*.parquet")}


def test_layer_without_a_required_column_is_rejected(spark, rates_csv, tmp_path):
    root = str(tmp_path / "layer")
    write_layer(bronze_row(spark, "a", 1).drop("COSTO_ARTICULO"), root)
    (row,) = run_silver(spark, root, rates_csv, str(tmp_path / "silver")).collect()
    assert (row.status, row.reason, row.rows_out) == ("failed", "missing_columns: COSTO_ARTICULO", 0)


def test_column_without_values_is_no_missing_column(spark, rates_csv, tmp_path):
    root, silver_root = str(tmp_path / "layer"), str(tmp_path / "silver")
    write_layer(bronze_row(spark, "San Juan", 1).withColumn("DESC_RUBRO", F.lit(None).cast("string")), root)
    (row,) = run_silver(spark, root, rates_csv, silver_root).collect()
    assert (row.SUCURSAL, row.status, row.rows_in, row.rows_out, row.rows_without_rate) == ("San Juan", "ok", 1, 1, 0)


def test_file_of_another_type_is_left_out(spark, rates_csv, tmp_path):
    root, silver_root, gold_root = (str(tmp_path / n) for n in ("layer", "silver", "gold"))
    write_layer(bronze_row(spark, "a", 1).unionByName(bronze_row(spark, "b", 1)), root)
    run_silver(spark, root, rates_csv, silver_root)
    silver = read_layer(spark, silver_root, SILVER)
    write_layer(stage(silver.where("SUCURSAL = 'a'")).withColumn("FECHA", F.lit("5 de enero")), silver_root)
    audit = {r.SUCURSAL: (r.status, r.reason) for r in run_gold(spark, silver_root, gold_root).collect()}
    assert audit == {"a": ("failed", "unreadable_types: FECHA string"), "b": ("ok", None)}


def foreign_file(root, branch, month, columns):
    """A branch-month by another writer: columns replace or extend the contract's text columns."""
    data = dict.fromkeys(RAW_REQUIRED, ["1", "2"]) | {"FECHA": pa.array([datetime(2024, month, 5)] * 2, pa.timestamp("ns"))}
    folder = Path(root, f"sucursal={branch}/year=2024/month={month}")
    folder.mkdir(parents=True)
    pq.write_table(pa.table(data | columns), folder / "ventas.parquet")


def test_files_of_other_writers(spark, rates_csv, tmp_path):
    """Whole numbers, numbers with missing ones, nanoseconds, dictionaries, columns without values, columns beyond the contract."""
    root, silver_root, gold_root = (str(tmp_path / n) for n in ("layer", "silver", "gold"))
    write_layer(bronze_row(spark, "a", 1).withColumn("_extra", F.create_map(F.lit("OBS"), F.lit("own"))), root)
    foreign_file(root, "b", 1, {"VALOR_ARTICULO": pa.array([5, 7], pa.int64()), "OBS": ["x", None], "month": [9, 9], "__index_level_0__": [0, 1]})
    numbers = {
        "VALOR_ARTICULO": pa.array([2.5, None], pa.float64()),
        "COSTO_ARTICULO": pa.array([1, 2], pa.uint8()),
        "ID_ARTICULO": pa.array([True, False]),
        "NUMERO_TICKET": pa.array([Decimal("12.70"), Decimal("3.00")], pa.decimal128(9, 2)),
        "DESC_ARTICULO": pa.array(["pan", "vino"]).dictionary_encode(),
        "DESC_RUBRO": pa.nulls(2),
        "LISTA": pa.array([[1, 2], None], pa.list_(pa.int64())),
    }
    foreign_file(root, "San {J,*}", 2, numbers)
    foreign_file(root, "c", 1, {"FECHA": ["2024-01-05"] * 2})
    foreign_file(root, "d", 1, {"fecha": ["2024-01-05"] * 2})
    foreign_file(root, "e", 1, {})
    Path(root, "sucursal=e/year=2024/month=1/ventas.parquet").write_bytes(b"no file")
    foreign_file(root, "f", 1, {"FECHA": pa.array([datetime(1969, 12, 31, 23, 59, 59, 999999), None], pa.timestamp("ns"))})

    audit = {r.SUCURSAL: r for r in run_silver(spark, root, rates_csv, silver_root).collect()}
    assert {k: (r.status, r.reason, r.rows_in, r.rows_out) for k, r in audit.items()} == {
        "a": ("ok", None, 1, 1),
        "b": ("ok", None, 2, 2),
        "San {J,*}": ("ok", None, 2, 1),
        "c": ("failed", "unreadable_types: FECHA string", 2, 0),
        "d": ("failed", "ambiguous_columns: fecha", 2, 0),
        "e": ("failed", "unreadable_file: ArrowInvalid", None, 0),
        "f": ("ok", None, 2, 2),
    }
    assert (audit["b"].unexpected, audit["San {J,*}"].unexpected, audit["a"].unexpected) == ("OBS", "LISTA", None)
    assert (audit["b"].rows_without_rate, audit["San {J,*}"].rows_without_rate) == (0, 1)

    silver = {(r.SUCURSAL, r.NUMERO_TICKET): r for r in read_layer(spark, silver_root, SILVER_STORED).collect()}
    assert [silver["b", n].VALOR_ARTICULO for n in (1, 2)] == [5.0, 7.0]
    assert [silver["b", n]._extra for n in (1, 2)] == [{"OBS": "x"}, None] and silver["a", 1]._extra == {"OBS": "own"}
    one = silver["San {J,*}", 12]
    assert (one.VALOR_ARTICULO, one.COSTO_ARTICULO, one.ID_ARTICULO, one.DESC_ARTICULO, one.DESC_RUBRO) == (2.5, 1.0, 1, "pan", None)
    assert (one.FECHA, one._extra) == (datetime(2024, 2, 5), {"LISTA": "[1, 2]"})
    moments = sorted((r.FECHA for (k, _), r in silver.items() if k == "f"), key=str)
    assert moments == [datetime(1969, 12, 31, 23, 59, 59, 999999), None]
    assert {r.status for r in run_gold(spark, silver_root, gold_root).collect()} == {"ok"}


def test_silver_by_another_writer(spark, rates_csv, tmp_path):
    """Text and whole numbers in silver become its numbers; what is missing stays missing."""
    root, silver_root, gold_root = (str(tmp_path / n) for n in ("layer", "silver", "gold"))
    write_layer(bronze_row(spark, "a", 1).unionByName(bronze_row(spark, "b", 2)), root)
    run_silver(spark, root, rates_csv, silver_root)
    silver = stage(read_layer(spark, silver_root, SILVER))
    text = silver.where("SUCURSAL = 'b'").withColumns({c: F.col(c).cast("string") for c in ("VENTA_ARS", "VENTA_USD", "CANTIDAD_VENDIDA")})
    write_layer(text.withColumn("DIA_MES", F.col("DIA_MES").cast("int")), silver_root)
    got = {r.SUCURSAL: r for r in read_any_layer(spark, silver_root, SILVER).collect()}
    assert {k: tuple(r) for k, r in got.items()} == {r.SUCURSAL: tuple(r) for r in silver.collect()}
    assert got["b"].VENTA_USD is None and got["b"].VENTA_ARS == 1.0
    assert {r.status for r in run_gold(spark, silver_root, gold_root).collect()} == {"ok"}


def test_no_accepted_file(spark, rates_csv, tmp_path):
    foreign_file(tmp_path / "layer", "c", 1, {"FECHA": ["2024-01-05"] * 2})
    (row,) = run_silver(spark, str(tmp_path / "layer"), rates_csv, str(tmp_path / "silver")).collect()
    assert (row.status, row.rows_in, row.rows_out) == ("failed", 2, 0)


def test_extra_columns_reach_silver(spark, rates_csv, tmp_path):
    root, silver_root = str(tmp_path / "layer"), str(tmp_path / "silver")
    noted = bronze_row(spark, "a", 1).withColumn("_extra", F.create_map(F.lit("OBS"), F.lit("x")))
    write_layer(noted.withColumn("OTRA", F.lit(1)), root)
    (row,) = run_silver(spark, root, rates_csv, silver_root).collect()
    assert row.unexpected == "OTRA"
    assert [r._extra for r in read_layer(spark, silver_root, SILVER_STORED).collect()] == [{"OBS": "x", "OTRA": "1"}]


def test_one_file_without_a_required_column_is_left_out(spark, rates_csv, tmp_path):
    root, silver_root = str(tmp_path / "layer"), str(tmp_path / "silver")
    write_layer(bronze_row(spark, "a", 1).drop("COSTO_ARTICULO"), root)
    write_layer(bronze_row(spark, "b", 1), root)
    audit = {r.SUCURSAL: (r.status, r.reason) for r in run_silver(spark, root, rates_csv, silver_root).collect()}
    assert audit == {"a": ("failed", "missing_columns: COSTO_ARTICULO"), "b": ("ok", None)}
    assert [r.SUCURSAL for r in read_layer(spark, silver_root, SILVER).collect()] == ["b"]


def test_bronze_without_source_position_uses_file_order(spark, rates_csv, tmp_path):
    root, silver_root = str(tmp_path / "layer"), str(tmp_path / "silver")
    rows = bronze_row(spark, "a", 1, "3").unionByName(bronze_row(spark, "a", 1, "4"))
    plain = rows.drop("_src_file", "_src_sheet_no", "_src_row", "_extra").coalesce(1)
    plain.drop(*UNIT).write.parquet(root + "/sucursal=a/year=2024/month=1")
    run_silver(spark, root, rates_csv, silver_root)
    assert [r.CANTIDAD_VENDIDA for r in read_layer(spark, silver_root, SILVER).collect()] == [3]


def test_rates_file(spark, rates_csv, tmp_path):
    assert read_rates(spark, rates_csv).count() == 3
    got = {(r.year, r.month): r.exchange_rate_ars_usd for r in load_rates(spark, rates_csv).collect()}
    assert got == {(2024, 1): 800.0, (2024, 2): None}
    folder = tmp_path / "rates"
    folder.mkdir()
    (folder / "1.csv").write_text("year,month,exchange_rate_ars_usd\n2024,1,800\n2024,13,1\n")
    assert [r.month for r in off_calendar(read_rates(spark, str(folder))).collect()] == [13]
    (folder / "2.csv").write_text("month,year,exchange_rate_ars_usd\n2,2024,900\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_rates(spark, str(folder)).collect()
    bad = tmp_path / "bad.csv"
    bad.write_text("year,month\n2024,1\n")
    with pytest.raises(ContractError):
        load_rates(spark, str(bad))


def test_catalog_tables(spark, rates_csv, tmp_path):
    root = str(tmp_path / "layer")
    write_layer(bronze_row(spark, "007", 1), root)
    table = register_table(spark, "test_bronze", "ventas", BRONZE_STORED, root, repair=False)
    assert spark.table(table).count() == 0
    repair_partitions(spark, table)
    row = preview(spark, table).first()
    assert (row.sucursal, row.year, row.month, row.CANTIDAD_VENDIDA) == ("007", 2024, 1, "1")
    write_layer(bronze_row(spark, "008", 1, "7"), root)
    assert spark.table(table).count() == 1
    repair_partitions(spark, table)
    assert spark.table(table).count() == 2
    top = preview(spark, table, 1, [F.col("CANTIDAD_VENDIDA").desc()]).collect()
    assert [(r.sucursal, r.CANTIDAD_VENDIDA) for r in top] == [("008", "7")]
    register_table(spark, "test_bronze", "ventas", BRONZE_STORED, root)
    assert spark.table(table).count() == 2
    create_database(spark, "test_reference")
    rates = register_rates_table(spark, "test_reference", "rates", rates_csv.rsplit("/", 1)[0])
    assert [tuple(r) for r in spark.table(rates).orderBy("exchange_rate_ars_usd").collect()] == [
        (2024, 2, None),
        (2024, 1, 800.0),
        (2024, 1, 900.0),
    ]


def test_table_step(spark, rates_csv, tmp_path, monkeypatch, capsys):
    write_layer(bronze_row(spark, "007", 1), str(tmp_path / "layer"))
    for layer, root in (("bronze", tmp_path / "layer"), ("rates", Path(rates_csv).parent)):
        monkeypatch.setattr("sys.argv", ["saleslake", "table", layer, str(root), "--database", "test_step", "--name", layer])
        main()
    assert "test_step.bronze" in capsys.readouterr().out
    assert (spark.table("test_step.bronze").count(), spark.table("test_step.rates").count()) == (1, 3)


def test_staging_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get(CHECKPOINT_DIR)


def test_staged_tables_go_with_their_job(spark):
    with Staging(spark) as staging:
        table = staging.stage(spark.range(3))
        assert table.count() == 3
        (path,) = {Path(f.removeprefix("file:")).parent for f in table.inputFiles()}
        assert path.exists()
    assert not path.exists()
