"""Prioritised rule cascade that links a denied claim line to one billing context.

Every rule is an equality on a subset of (remittance, card, service, month, guide,
value).  So a rule is a key: billing lines are exploded to the keys under which the rules
can see them and aggregated to one row per key; denials are exploded to the keys they ask
for.  The join is many-to-one.  Its cost is linear in denials and lines even when one card
or service (for example the blank one) holds a large share of both sides, because no
denial/line pair is ever formed to decide a link, and the denials of such a key stay spread
over all tasks (see :mod:`claimweave.operators.skew`).  A context is unique when each of its parts
(process, remittance, account) has one value or is always null.

Each denial asks for up to fifteen keys, so the rows that are shuffled are kept short: a key travels as 128 bits of
two hashes of all its fields, an id of hexadecimal digits as its bytes, and a key's lines come back as a few numbers.
Both sides name the rule, so that a filter on the rule reaches the probes and the lines before they are shuffled.

Lines are reduced by numbers only, so that the aggregation is a hash aggregation: a process stands for itself as a hash
until the end, and the first line of a key is the smallest of numbers made of its entry and its
content key (``line_order``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimweave import fixed_values as fv
from claimweave.functions import numbers as N
from claimweave.functions import text as T
from claimweave.functions.identity import short_id, whole_id
from claimweave.operators.skew import many_to_one
from claimweave.plans.remittances import expected_remittances
from claimweave.plans.staging import ITEM_COLUMNS, item_digest

#: What the rules and the search for expected remittances read of a denial.
DENIAL_COLUMNS = (
    "id_registro",
    "numero_processo",
    "competencia_producao",
    "numero_protocolo",
    "valor_protocolo_cogestao",
    "status_associacao",
    "data_realizacao",
    "numero_guia_senha",
    "codigo_servico",
    "codigo_beneficiario",
    "valor_processado",
)

_KEY_FIELDS = ("prioridade", "k_remessa", "k_carteira", "k_servico", "k_mes", "k_guia", "k_valor")
# Two hashes of all fields stand for the key wherever it is shuffled; only the rule goes along by itself.
RULE_KEY = ("k", "k2")
_NO_REMITTANCE = -1
_ANY_MONTH = -1
_LEGACY_FROM = 21
# 2 to the 63rd makes any entry positive; 2 to the 60th leaves room for 15 hexadecimal digits.
_SHIFT, _BITS = str(2**63), str(2**60)

CRITERIA = {
    fv.DIRECT_RULE[0]: fv.DIRECT_RULE[1],
    **{rule[0]: rule[1] for rule in (*fv.FALLBACK_RULES, *fv.LEGACY_RULES)},
}


def criterion_of(priority: Column) -> Column:
    return F.create_map(*[F.lit(x) for pair in CRITERIA.items() for x in pair])[priority]


def _key(priority, remittance, card, service, month=None, guide=None, value=None) -> Column:
    values = (
        F.lit(priority),
        remittance.cast("bigint"),
        card,
        service,
        F.lit(_ANY_MONTH) if month is None else month,
        F.lit("") if guide is None else guide,
        (F.lit(0) if value is None else value).cast(N.MONEY),
    )
    return F.struct(*[v.alias(n) for v, n in zip(values, _KEY_FIELDS)])


def _month_number(day: str) -> Column:
    return F.year(day) * 12 + F.month(day)


def _item_keys(rules, remittance: Column, direct: bool) -> Column:
    pf, tuss = F.col("cd_pro_fat_normalizado"), F.col("cd_tuss_normalizado")
    services = {
        "pf": pf,
        "tuss": tuss,
        "pf_tuss": F.when(pf != "", pf).otherwise(tuss),
        "tuss_pf": F.when(tuss != "", tuss).otherwise(pf),
    }
    card, guide = F.col("nr_carteira_normalizada"), F.col("nr_guia_normalizada")
    keys = []
    if direct:
        named = (guide != "") & (card != "")
        keys.append(F.when(named, _key(1, remittance, card, pf, guide=guide)))
        keys.append(F.when(named & (tuss != pf), _key(1, remittance, card, tuss, guide=guide)))
    for priority, _, month_of, by_guide, service, filled, by_value in rules:
        month = F.col(f"_mes_{month_of}")
        usable = month.isNotNull() & remittance.isNotNull()
        if filled:
            usable = usable & (tuss != "")
        keys.append(
            F.when(
                usable,
                _key(
                    priority,
                    remittance,
                    card,
                    services[service],
                    month,
                    guide if by_guide else None,
                    F.col("valor_item") if by_value else None,
                ),
            )
        )
    return F.array(*keys)


def _denial_keys(rules, remittance: Column, direct: bool) -> Column:
    card, guide, service = (F.col(c) for c in ("_carteira", "_guia", "_servico"))
    month, value = F.col("_mes"), F.col("_valor")
    keys = []
    if direct:
        keys.append(F.when((guide != "") & (card != ""), _key(1, remittance, card, service, guide=guide)))
    for priority, _, _, by_guide, _, _, by_value in rules:
        keys.append(
            F.when(
                month.isNotNull() & remittance.isNotNull(),
                _key(priority, remittance, card, service, month, guide if by_guide else None, value if by_value else None),
            )
        )
    return F.array(*keys)


def line_order() -> Column:
    """A line's place among the lines of a key as one number: entry (nulls last), then the first 60 bits of its content key.

    It is also what a line is found by again. Two lines with one number would have to share the entry
    and 60 bits of a digest.
    """
    entry = F.coalesce(F.col("cd_lancamento").cast("decimal(20,0)"), F.lit(_SHIFT).cast("decimal(20,0)")) + F.lit(_SHIFT).cast("decimal(20,0)")
    digest = F.conv(F.substring(item_digest(), 1, 15), 16, 10).cast("decimal(19,0)")
    return (entry * F.lit(_BITS).cast("decimal(19,0)") + digest).cast("decimal(38,0)")


def _with_months(lines: DataFrame) -> DataFrame:
    names = ("competencia", "lancamento", "atendimento")
    return lines.withColumns({f"_mes_{n}": _month_number(f"dt_{n}") for n in names}).withColumn("_linha", line_order())


def _with_match_fields(denials: DataFrame) -> DataFrame:
    return (
        denials.withColumn("_mes", _month_number("data_realizacao"))
        .withColumn("_guia", T.norm_key("numero_guia_senha"))
        .withColumn("_servico", T.norm_key("codigo_servico"))
        .withColumn("_carteira", T.strip_zeros("codigo_beneficiario"))
        .withColumn("_valor", N.money("valor_processado"))
    )


def _short_id() -> Column:
    """The denial's id in as few bytes as it can be told from."""
    return short_id("id_registro").alias("id_registro")


def _whole_id() -> Column:
    """The id that :func:`_short_id` shortened."""
    return whole_id("id_registro").alias("id_registro")


def _keyed(rows: DataFrame) -> DataFrame:
    """The key fields replaced by their two hashes and the rule; a key with a null field finds nothing."""
    whole = rows.dropna(subset=list(_KEY_FIELDS))
    others = [c for c in rows.columns if c not in _KEY_FIELDS]
    first, second = _two_hashes(_KEY_FIELDS)
    return whole.select(first.alias("k"), second.alias("k2"), "prioridade", *others)


def _two_hashes(parts) -> tuple[Column, Column]:
    """128 bits: the parts hashed forwards, and backwards from another start."""
    return F.xxhash64(*parts), F.xxhash64(F.lit("2"), *reversed(parts))


def _report_line_keys(report_items: DataFrame, extra=()) -> DataFrame:
    keys = _item_keys(fv.FALLBACK_RULES, F.lit(_NO_REMITTANCE).cast("bigint"), direct=True)
    line = ("numero_processo", "cd_remessa", "conta", "cd_lancamento", "_linha")
    return _keyed(_with_months(report_items).select(F.inline(keys), *line, *extra))


def _hospital_line_keys(items: DataFrame, extra=()) -> DataFrame:
    keys = _item_keys(fv.LEGACY_RULES, F.col("cd_remessa"), direct=False)
    process = F.lit(None).cast("string").alias("numero_processo")
    line = ("cd_remessa", "conta", "cd_lancamento", "_linha")
    return _keyed(_with_months(items).select(F.inline(keys), process, *line, *extra))


def _report_probes(denials: DataFrame) -> DataFrame:
    keys = _denial_keys(fv.FALLBACK_RULES, F.lit(_NO_REMITTANCE).cast("bigint"), direct=True)
    own = F.lit(None).cast("string").alias("_processo")
    return _keyed(_with_match_fields(denials).select(_short_id(), own, F.inline(keys)))


def _legacy_probes(denials: DataFrame, remittances: DataFrame) -> DataFrame:
    linked = denials.filter(F.col("status_associacao").startswith(fv.LINKED_STATUS_PREFIX))
    expected = expected_remittances(linked, remittances, "inner")
    keys = _denial_keys(fv.LEGACY_RULES, F.col("cd_remessa"), direct=False)
    own = F.col("numero_processo").alias("_processo")
    return _keyed(_with_match_fields(expected).select(_short_id(), own, F.inline(keys)))


def _reduce_lines(lines: DataFrame) -> DataFrame:
    """One row per rule key: is its context unique and is its entry, the parts of both, and the first line in order."""
    reduced = lines.withColumn("_processo", _process_hash("numero_processo")).groupBy(*RULE_KEY, "prioridade").agg(
        F.count(F.lit(1)).alias("n"),
        *[x for name, part in _PARTS.items() for x in (F.min(part).alias(f"{name}_a"), F.max(part).alias(f"{name}_b"), F.count(part).alias(f"{name}_n"))],
        F.min("_linha").alias("_linha"),
    )
    return reduced.select(
        *RULE_KEY,
        "prioridade",
        (_constant("processo") & _constant("remessa") & _constant("conta")).alias("_contexto_unico"),
        _constant("item").alias("_item_unico"),
        *[F.col(f"{name}_a").alias(f"_{name}") for name in _PARTS],
        "_linha",
    )


def _meet(probes: DataFrame, lines: DataFrame) -> DataFrame:
    """Probes with the one row of their key. The join is on the first hash and the rule, which the aggregate below is not
    partitioned by, so that adaptive execution can split a hot key (see :mod:`claimweave.operators.skew`); the second
    hash is compared as no equality that the planner would add to the join keys.
    """
    one = lines.withColumnsRenamed({c: f"_{c}" for c in (*RULE_KEY, "prioridade")})
    same = (F.col("k") == F.col("_k")) & (F.col("prioridade") == F.col("_prioridade")) & (F.col("k2").bitwiseXOR(F.col("_k2")) == 0)
    return probes.join(one, same).drop(*RULE_KEY, "_k", "_k2", "_prioridade")


def _hits(probes: DataFrame, lines: DataFrame) -> DataFrame:
    """Probes with the reduced lines of their key."""
    return _meet(probes.withColumnRenamed("_processo", "_proprio"), _reduce_lines(lines))


def _process_hash(name: str) -> Column:
    return F.when(F.col(name).isNotNull(), F.xxhash64(name))


#: Parts of a context and the entry, and the columns that hold them.
_PARTS = {"processo": "_processo", "remessa": "cd_remessa", "conta": "conta", "item": "cd_lancamento"}
_CONTEXT, _ENTRY = ("_processo", "_remessa", "_conta"), ("_item",)


def _constant(name: str) -> Column:
    """All rows have one value, or all have none."""
    whole = (F.col(f"{name}_n") == F.col("n")) & (F.col(f"{name}_a") == F.col(f"{name}_b"))
    return (F.col(f"{name}_n") == 0) | F.coalesce(whole, F.lit(False))


def rule_results(
    denials: DataFrame, report_items: DataFrame, items: DataFrame, remittances: DataFrame
) -> DataFrame:
    """Per denial and rule with candidates: is the context unique, is the line unique, which line is first.

    The remittance in a legacy key keeps lines of different expected remittances apart;
    they meet again here, per denial and rule. ``_processo`` is the hash of the line's process, where it has one,
    and ``_proprio`` the process of the denial itself, for legacy rules. ``_legado`` tells legacy rules from report rules by
    a constant of each side, so that a filter on it drops the other side with all its inputs.
    """
    report_hits = _hits(_report_probes(denials), _report_line_keys(report_items))
    legacy_hits = _hits(_legacy_probes(denials, remittances), _hospital_line_keys(items))
    hits = _both_sides(report_hits, legacy_hits)

    def one(unique: str, names: tuple[str, ...]) -> Column:
        """Every key has one value of each part (or none), and it is the same for all keys."""
        equal = F.min(unique)
        for name in names:
            whole = (F.count(name) == F.count(F.lit(1))) & (F.min(name) == F.max(name))
            equal = equal & ((F.count(name) == 0) | F.coalesce(whole, F.lit(False)))
        return equal

    # Both aggregations below cluster on the denial id, so one exchange serves the two. A rule of a denial has one own process.
    return (
        hits.repartition(_whole_id())
        .withColumn("id_registro", _whole_id())
        .groupBy("id_registro", "_legado", "prioridade", "_proprio")
        .agg(
            one("_contexto_unico", _CONTEXT).alias("seguro"),
            one("_item_unico", _ENTRY).alias("item_unico"),
            F.min("_processo").alias("_processo"),
            F.min("_linha").alias("_linha"),
        )
        .select("id_registro", "prioridade", "seguro", "item_unico", "_processo", "_proprio", "_linha", "_legado")
    )


def _both_sides(report: DataFrame, legacy: DataFrame) -> DataFrame:
    """Rows of both rule sets, with the constant ``_legado``."""
    return report.withColumn("_legado", F.lit(False)).unionByName(legacy.withColumn("_legado", F.lit(True)))


def outcomes(results: DataFrame) -> DataFrame:
    """Per denial: the first safe rule with its line, and the first unsafe stored rule.

    Unsafe direct and fallback candidates are not stored, so only legacy rules can be the
    unsafe one.
    """
    safe = F.when(F.col("seguro"), F.col("prioridade"))
    unsafe = F.when(~F.col("seguro") & (F.col("prioridade") >= _LEGACY_FROM), F.col("prioridade"))
    pick = F.when(F.col("seguro"), F.struct("prioridade", "item_unico", "_processo", "_proprio", "_linha"))
    return results.groupBy("id_registro").agg(
        F.min_by(pick, safe).alias("escolha"), F.min(unsafe).alias("prioridade_insegura")
    )


def resolve(outcome: DataFrame, items: DataFrame, report_items: DataFrame) -> DataFrame:
    """Exactly one billing line per resolvable denial, with the rule that chose it.

    The chosen lines are first cut down to one row per line, however many denials chose it, and
    processes to one row per process; both joins are many-to-one.
    """
    chosen = outcome.filter(F.col("escolha").isNotNull()).select("id_registro", "escolha.*")
    wanted = chosen.select("_linha").distinct()
    lines = items.withColumn("_linha", line_order()).join(wanted, "_linha", "left_semi").dropDuplicates(["_linha"])
    processes = report_items.select(_process_hash("numero_processo").alias("_processo"), "numero_processo").filter("_processo is not null").dropDuplicates(["_processo"])
    named = many_to_one(chosen, processes, ["_processo"], "left").withColumn("numero_processo", F.coalesce("numero_processo", "_proprio"))
    renamed = {"nr_guia_normalizada": "nr_guia", "cd_pro_fat_normalizado": "cd_pro_fat", "cd_tuss_normalizado": "cd_tuss"}
    shown = [c for c in ITEM_COLUMNS if not c.startswith("nr_carteira")]
    return many_to_one(named, lines, ["_linha"]).select(
        "id_registro",
        "numero_processo",
        criterion_of(F.col("prioridade")).alias("criterio"),
        F.when(F.col("item_unico"), "item_unico").otherwise("conta_unica").alias("status_correspondencia"),
        *[F.col(c).alias(renamed.get(c, c)) for c in shown],
    )


# --- the same cascade shown as tables -------------------------------------


def rule_counts(
    denials: DataFrame, report_items: DataFrame, items: DataFrame, remittances: DataFrame
) -> DataFrame:
    """Per denial and rule: number of candidate rows, contexts and lines, without forming pairs; ``_legado`` as in :func:`rule_results`.

    Lines lie together by account before they are spread over their keys, so that the first two groupings shuffle nothing.
    """

    def counted(lines: DataFrame) -> DataFrame:
        context, key = ["numero_processo", "cd_remessa", "conta"], [*RULE_KEY, "prioridade"]
        entries = lines.groupBy(*key, *context, "cd_lancamento").agg(F.count(F.lit(1)).alias("n"))
        contexts = entries.groupBy(*key, *context).agg(F.count(F.lit(1)).alias("itens"), F.sum("n").alias("n"))
        return contexts.groupBy(*key).agg(
            F.count(F.lit(1)).alias("contextos"), F.sum("itens").alias("itens"), F.sum("n").alias("candidatos")
        )

    account = ("cd_remessa", "conta")
    report = _meet(_report_probes(denials).drop("_processo"), counted(_report_line_keys(report_items.repartition(*account))))
    legacy = _meet(_legacy_probes(denials, remittances).drop("_processo"), counted(_hospital_line_keys(items.repartition(*account))))
    # Expected remittances of one denial are different, so their contexts add up.
    return (
        _both_sides(report, legacy)
        .groupBy("id_registro", "_legado", "prioridade")
        .agg(
            F.sum("candidatos").alias("quantidade_candidatos"),
            F.sum("contextos").alias("quantidade_contextos"),
            F.sum("itens").alias("quantidade_itens"),
        )
        .select(
            _whole_id(),
            "prioridade",
            "quantidade_candidatos",
            "quantidade_contextos",
            "quantidade_itens",
            criterion_of(F.col("prioridade")).alias("criterio"),
            "_legado",
        )
    )


def _expand(probes: DataFrame, lines: DataFrame) -> DataFrame:
    joined = probes.join(lines, [*RULE_KEY, "prioridade"])
    return joined.select(
        "prioridade",
        criterion_of(F.col("prioridade")).alias("criterio"),
        _whole_id(),
        F.coalesce("numero_processo", "_processo").alias("numero_processo_resolvido"),
        "linha.*",
    )


def _line_struct() -> Column:
    return F.struct(*ITEM_COLUMNS).alias("linha")


def _stored_rules(results: DataFrame) -> DataFrame:
    """The report rule whose candidates are kept for each denial: direct first, else the first safe fallback."""
    safe = results.filter(~F.col("_legado") & F.col("seguro") & (F.col("prioridade") < _LEGACY_FROM))
    return safe.groupBy("id_registro").agg(F.min("prioridade").alias("prioridade"))


def report_candidates(
    denials: DataFrame, report_items: DataFrame, results: DataFrame
) -> DataFrame:
    """Candidate rows of the kept direct or fallback rule; all of one denial lie in one account."""
    stored = _stored_rules(results).select(_short_id(), "prioridade")
    kept = _report_probes(denials).join(stored, ["id_registro", "prioridade"], "left_semi")
    rows = _expand(kept, _report_line_keys(report_items, [_line_struct()]))
    direct, fallback = rows.filter("prioridade = 1"), rows.filter("prioridade > 1")
    return direct.distinct().unionByName(fallback)


def legacy_candidates(denials: DataFrame, items: DataFrame, remittances: DataFrame) -> DataFrame:
    """Every candidate row of the legacy rules.

    This is the one frame that lists denial/line pairs, for inspection; linking never
    reads it (see :func:`rule_results` and :func:`rule_counts`).
    """
    return _expand(_legacy_probes(denials, remittances), _hospital_line_keys(items, [_line_struct()]))


def candidates(
    denials: DataFrame, report_items: DataFrame, items: DataFrame, remittances: DataFrame
) -> DataFrame:
    """Stored candidates of all three rule sets, for inspection."""
    results = rule_results(denials, report_items, items, remittances)
    return report_candidates(denials, report_items, results).unionByName(
        legacy_candidates(denials, items, remittances)
    )
