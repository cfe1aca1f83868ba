"""The keyed cascade against a naive pair-by-pair evaluation, and small mart cases."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from claimweave import fixed_values as fv
from claimweave.plans import cascade as C
from claimweave.plans.staging import ITEM_COLUMNS

LINE = "cd_remessa bigint, conta bigint, cd_lancamento bigint, nr_guia_normalizada string, nr_carteira_normalizada string, cd_pro_fat_normalizado string, cd_tuss_normalizado string, dt_atendimento timestamp_ntz, dt_competencia date, dt_lancamento timestamp_ntz, valor_item decimal(18,2)"
DENIAL = "id_registro string, numero_processo string, competencia_producao string, numero_protocolo string, valor_protocolo_cogestao decimal(18,2), status_associacao string, data_realizacao date, numero_guia_senha string, codigo_servico string, codigo_beneficiario string, valor_processado decimal(18,2)"


def _day(rng):
    return rng.choice([None, dt.date(2026, 1, 5), dt.date(2026, 2, 6)])


def _lines(rng, n):
    at = lambda d: d and dt.datetime(d.year, d.month, d.day)
    return [
        (
            rng.choice([1, 2]),
            rng.choice([None, 10, 11]),
            rng.choice([None, 1, 2]),
            rng.choice(["", "G1"]),
            rng.choice(["", "7"]),
            rng.choice(["", "S1", "S2"]),
            rng.choice(["", "S1", "S3"]),
            at(_day(rng)),
            _day(rng),
            at(_day(rng)),
            Decimal(rng.choice([1, 2])),
        )
        for _ in range(n)
    ]


def _denials(rng, n):
    return [
        (
            f"d{i}",
            rng.choice(["P1/2025", "P2/2025"]),
            "01/2026",
            rng.choice(["A", "B"]),
            Decimal(5),
            rng.choice(["ASSOCIADO", "AMBIGUO"]),
            _day(rng),
            rng.choice(["", " g1", None]),
            rng.choice(["", "s1", "S2", "S3"]),
            rng.choice(["", "07", "x", None]),
            Decimal(rng.choice([1, 2])),
        )
        for i in range(n)
    ]


def _naive(denials, report, hospital, remittances):
    """{(denial, rule): list of (process, remittance, account, entry)} by checking every pair."""
    found = {}

    def month(d):
        return d and (d.year, d.month)

    for d in denials:
        guide, service = (d[7] or "").strip().upper(), d[8].strip().upper()
        card = "".join(c for c in d[9] or "" if c.isdigit()).lstrip("0")

        def add(rule, process, i):
            found.setdefault((d[0], rule), []).append((process, i[0], i[1], i[2]))

        def rules(table, i, process):
            for prio, _, of, by_guide, serv, filled, by_value in table:
                day = {"competencia": i[8], "lancamento": i[9], "atendimento": i[7]}[of]
                code = {"pf": i[5], "tuss": i[6], "pf_tuss": i[5] or i[6], "tuss_pf": i[6] or i[5]}[serv]
                if day is None or d[6] is None or month(day) != month(d[6]) or i[4] != card or code != service:
                    continue
                if (by_guide and i[3] != guide) or (filled and not i[6]) or (by_value and i[10] != d[10]):
                    continue
                add(prio, process, i)

        for process, i in report:
            if i[3] == guide != "" and i[4] == card != "" and service in (i[5], i[6]):
                add(1, process, i)
            rules(fv.FALLBACK_RULES, i, process)
        if d[5].startswith("ASSOCIADO"):
            for process, month_label, protocol, value, remittance in remittances:
                if (process, month_label, protocol, value) == (d[1], d[2], d[3], d[4]):
                    for i in hospital:
                        if i[0] == remittance:
                            rules(fv.LEGACY_RULES, i, d[1])
    return found


def _items(spark, data):
    frame = spark.createDataFrame(data, LINE)
    kinds = {"qt_lancamento": "decimal(18,4)"}
    return frame.select(
        *[F.col(c) if c in frame.columns else F.lit(None).cast(kinds.get(c, "string")).alias(c) for c in ITEM_COLUMNS]
    )


@pytest.mark.parametrize("seed", [1, 2])
def test_keyed_rules_equal_pairwise_rules(spark, seed):
    rng = random.Random(seed)
    denials, hospital = _denials(rng, 40), _lines(rng, 30)
    report = list(dict.fromkeys((rng.choice(["P1/2025", "P9/2025"]), i) for i in _lines(rng, 25)))
    remittances = [("P1/2025", "01/2026", "A", Decimal(5), 1), ("P1/2025", "01/2026", "A", Decimal(5), 2), ("P2/2025", "01/2026", "B", Decimal(5), 2)]
    d = spark.createDataFrame(denials, DENIAL)
    h = _items(spark, hospital)
    r = _items(spark, [i for _, i in report]).withColumn("numero_processo", F.lit(""))
    both = spark.createDataFrame([(p, *i) for p, i in report], "numero_processo string, " + LINE)
    r = both.select("numero_processo", *[F.col(c) if c in both.columns else F.lit(None).cast("string").alias(c) for c in ITEM_COLUMNS])
    m = spark.createDataFrame(remittances, "numero_processo string, competencia_producao string, numero_protocolo string, valor_protocolo decimal(18,2), cd_remessa bigint")

    naive = _naive(denials, report, hospital, remittances)
    got = {(x["id_registro"], x["prioridade"]): x for x in C.rule_results(d, r, h, m).collect()}
    assert set(got) == set(naive)
    for key, pairs in naive.items():
        assert got[key]["seguro"] == (len({p[:3] for p in pairs}) == 1), key
        if got[key]["seguro"]:
            assert got[key]["item_unico"] == (len(set(pairs)) == 1), key

    counts = {(x["id_registro"], x["prioridade"]): x for x in C.rule_counts(d, r, h, m).collect()}
    for key, pairs in naive.items():
        assert counts[key]["quantidade_contextos"] == len({p[:3] for p in pairs})
        assert counts[key]["quantidade_itens"] == len(set(pairs))
        assert counts[key]["quantidade_candidatos"] == len(pairs)

    legacy = sorted((x["id_registro"], x["prioridade"]) for x in C.legacy_candidates(d, h, m).select("id_registro", "prioridade").collect())
    assert legacy == sorted((k for k, pairs in naive.items() if k[1] > 20 for _ in pairs))

    chosen = {x["id_registro"]: x["escolha"] for x in C.outcomes(C.rule_results(d, r, h, m)).collect()}
    for name in {k[0] for k in naive}:
        safe = [k[1] for k, pairs in naive.items() if k[0] == name and len({p[:3] for p in pairs}) == 1]
        assert (chosen[name]["prioridade"] if chosen[name] else None) == (min(safe) if safe else None)


def test_hot_blank_card_forms_no_pairs(spark):
    """2,000 denials and 2,000 lines that share one blank card stay linear."""
    lines = [(1, 10, i, "", "", "S1", "", None, dt.date(2026, 1, 5), None, Decimal(1)) for i in range(2000)]
    denials = [(f"d{i}", "P1/2025", "01/2026", "A", Decimal(5), "ASSOCIADO", dt.date(2026, 1, 9), "", "S1", "x", Decimal(1)) for i in range(2000)]
    m = spark.createDataFrame([("P1/2025", "01/2026", "A", Decimal(5), 1)], "numero_processo string, competencia_producao string, numero_protocolo string, valor_protocolo decimal(18,2), cd_remessa bigint")
    empty = _items(spark, lines).limit(0).withColumn("numero_processo", F.lit("P"))
    got = C.rule_results(spark.createDataFrame(denials, DENIAL), empty, _items(spark, lines), m).filter("prioridade = 22")
    assert got.filter("seguro and not item_unico").count() == 2000


def test_keys_are_shuffled_as_two_hashes(spark):
    """A probe carries no text of its key; remittances of another type still meet, and keys of another guide don't."""
    lines = [(1, 10, 3, "G1", "7", "S1", "", None, dt.date(2026, 1, 5), None, Decimal(1))]
    denials = [(f"d{g}", "P1/2025", "01/2026", "A", Decimal(5), "ASSOCIADO", dt.date(2026, 1, 9), g, "S1", "07", Decimal(1)) for g in ("G1", "G2")]
    d, empty = spark.createDataFrame(denials, DENIAL), _items(spark, lines).limit(0).withColumn("numero_processo", F.lit("P"))
    m = spark.createDataFrame([("P1/2025", "01/2026", "A", Decimal(5), 1)], "numero_processo string, competencia_producao string, numero_protocolo string, valor_protocolo decimal(18,2), cd_remessa int")
    assert C._report_probes(d).columns == ["k", "k2", "prioridade", "id_registro", "_processo"]
    got = C.rule_results(d, empty, _items(spark, lines), m).collect()
    assert {(r["id_registro"], r["prioridade"]) for r in got} >= {("dG1", 21), ("dG1", 22), ("dG2", 22)}
    assert all(r["seguro"] and r["item_unico"] and r["_proprio"] == "P1/2025" for r in got) and ("dG2", 21) not in {(r["id_registro"], r["prioridade"]) for r in got}


def test_rule_results_aggregate_by_hash(spark):
    """Only numbers are reduced, so no aggregation has to sort."""
    lines = [(1, 10, i, "", "", "S1", "", None, dt.date(2026, 1, 5), None, Decimal(1)) for i in range(5)]
    denials = [("d", "P1/2025", "01/2026", "A", Decimal(5), "ASSOCIADO", dt.date(2026, 1, 9), "", "S1", "x", Decimal(1))]
    m = spark.createDataFrame([("P1/2025", "01/2026", "A", Decimal(5), 1)], "numero_processo string, competencia_producao string, numero_protocolo string, valor_protocolo decimal(18,2), cd_remessa bigint")
    report = _items(spark, lines).withColumn("numero_processo", F.lit("P"))
    results = C.rule_results(spark.createDataFrame(denials, DENIAL), report, _items(spark, lines), m)
    plan = results._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_first_line_of_equal_and_missing_entries(spark):
    """Lines are ordered by entry, missing entries last, then by their content; negative entries come first."""
    lines = [(1, 10, e, "", "", "S1", "", None, dt.date(2026, 1, 5), None, Decimal(v)) for e, v in ((None, 1), (7, 2), (7, 3), (-4, 4), (2**62, 5))]
    frame = _items(spark, lines).withColumn("_linha", C.line_order())
    ordered = [r["cd_lancamento"] for r in frame.orderBy("_linha").collect()]
    assert ordered == [-4, 7, 7, 2**62, None] and frame.select("_linha").distinct().count() == 5
    entries = [r["valor_item"] for r in frame.filter("cd_lancamento = 7").orderBy("_linha").collect()]
    by_digest = [r["valor_item"] for r in frame.filter("cd_lancamento = 7").orderBy(C.item_digest()).collect()]
    assert entries == by_digest


def test_nothing_is_published_after_a_failed_test(spark, tmp_path):
    """Doubled denials break the uniqueness of the marts: the run stops before publication and leaves no files."""
    from checks.frames import Frames, run_ts
    from claimweave.api import run_linking
    from claimweave.operators.contracts import ContractFailure
    from claimweave.sources.tables import SnapshotStore

    frames = Frames(spark, "/root/testdata/sf0.001")
    inputs = frames.inputs()
    store = SnapshotStore(spark, str(tmp_path))
    with pytest.raises(ContractFailure) as stopped:
        run_linking(store, {**inputs, "association": inputs["association"].unionByName(inputs["association"])}, run_ts())
    assert {(t["modelo"], t["coluna"], t["teste"]) for t in stopped.value.failed} >= {("unlinked_mart", "id_registro", "unique"), ("linked_mart", "id_registro", "unique")}
    assert store.versions() == {} and not list(tmp_path.rglob("*.parquet"))


def test_ids_are_carried_as_bytes(spark):
    """Digests take half their digits; any other id, also one of capitals or none, comes back as it was."""
    ids = ["0123456789abcdef" * 4, "00ff", "0", "", "ABCD", "abc", "ff\n", "é", "\x01ff", None]
    rows = spark.createDataFrame([(i,) for i in ids], "id_registro string").select("id_registro", C._short_id().alias("curto"))
    back = rows.select(F.col("id_registro").alias("antes"), "curto", F.col("curto").alias("id_registro")).select("antes", F.length("curto").alias("n"), C._whole_id()).collect()
    assert [r["id_registro"] for r in back] == [r["antes"] for r in back] == ids
    assert back[0]["n"] == 33 and rows.select("curto").distinct().count() == len(ids)


def test_a_filter_on_the_rule_comes_before_the_shuffles(spark):
    """Counts of legacy rules shuffle no probe or line of the report rules, and the other way round."""
    from pyspark.sql.types import _parse_datatype_string as kind

    d, lines = spark.createDataFrame([], kind(DENIAL)), _items(spark, [(1, 10, 1, "", "", "S1", "", None, dt.date(2026, 1, 5), None, Decimal(1))])
    m = spark.createDataFrame([], "numero_processo string, competencia_producao string, numero_protocolo string, valor_protocolo decimal(18,2), cd_remessa bigint")
    report = lines.withColumn("numero_processo", F.lit("P"))
    for frame in (C.rule_counts(d, report, lines, m), C.rule_results(d, report, lines, m)):
        plan = frame.filter("prioridade > 20")._jdf.queryExecution().optimizedPlan().toString()
        kept = [line for line in plan.splitlines() if "Generate inline" in line]
        above = [plan.splitlines()[plan.splitlines().index(line) - 1] for line in kept]
        assert len(kept) == 4 and all("> 20" in line or ">= 21" in line for line in above), above


def test_a_filter_on_the_side_drops_the_other_side(spark):
    """Counts of legacy rules read no report line, and results of report rules no remittance and no hospital line."""
    from pyspark.sql.types import _parse_datatype_string as kind

    d, lines = spark.createDataFrame([], kind(DENIAL)), _items(spark, [(1, 10, 1, "", "", "S1", "", None, dt.date(2026, 1, 5), None, Decimal(1))])
    m = spark.createDataFrame([], "numero_processo string, competencia_producao string, numero_protocolo string, valor_protocolo decimal(18,2), cd_remessa bigint")
    report = lines.withColumn("numero_processo", F.lit("P"))
    for frame in (C.rule_counts(d, report, lines, m), C.rule_results(d, report, lines, m)):
        for side in ("_legado", "not _legado"):
            plan = frame.filter(side)._jdf.queryExecution().optimizedPlan().toString()
            assert plan.count("Generate inline") == 2 and plan.count("Join") == (2 if side == "_legado" else 1), plan


def test_counts_group_lines_where_they_lie(spark):
    """Beyond the exchange by account, lines are shuffled to their key and to the join, not for every grouping."""
    from pyspark.sql.types import _parse_datatype_string as kind

    lines = _items(spark, [(1, 10, 1, "", "", "S1", "", None, dt.date(2026, 1, 5), None, Decimal(1))])
    m = spark.createDataFrame([], "numero_processo string, competencia_producao string, numero_protocolo string, valor_protocolo decimal(18,2), cd_remessa bigint")
    d, report = spark.createDataFrame([], kind(DENIAL)), lines.withColumn("numero_processo", F.lit("P")).repartition(2)
    plan = C.rule_counts(d, report, lines.repartition(2), m).filter("_legado")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("cd_lancamento") and not [x for x in plan.splitlines() if "Exchange hashpartitioning(k" in x and "conta" in x], plan


def test_sources_of_the_cascade_are_written_once(spark):
    """No query of the cascade joins lines with their orders again for each of its readers."""
    from checks import linking
    from checks.frames import Frames

    for build in (linking._legacy, linking._rule_outcomes, linking._direct):
        plan = build(Frames(spark, "/root/testdata/sf0.001"))._jdf.queryExecution().optimizedPlan().toString()
        reads = build(Frames(spark, "/root/testdata/sf0.001")).inputFiles()
        assert "Generate" in plan and not [x for x in reads if "lineitem.parquet" in x or "orders.parquet" in x]
