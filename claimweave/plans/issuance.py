"""Invoice request tables: validation, eligibility, outcomes, batch verdicts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from claimweave import fixed_values as fv
from claimweave.functions import dates as D
from claimweave.functions import numbers as N
from claimweave.functions import text as T
from claimweave.operators.merge import merge_by_key
from claimweave.plans.staging import column_or_null

_REQUEST_COLUMNS = {
    "PACIENTE": "paciente",
    "LOCAL": "local",
    "TIPO ATENDIMENTO": "tipo_atendimento",
    "ATENDIMENTO": "atendimento",
    "CPF": "cpf",
    "VALOR": "valor",
    "RUA": "rua",
    "NUMERO CASA": "numero_casa",
    "BAIRRO": "bairro",
    "CIDADE": "cidade",
    "UF": "uf",
    "TIPO DE EXAME": "tipo_exame",
    "DATA": "data",
    "EMAIL": "email",
    "CEP": "cep",
    "COMPLEMENTO": "complemento",
    "TELEFONE": "telefone",
}


def header_name(name: str) -> str:
    """Column header without accents, upper case, single blanks."""
    import unicodedata

    text = unicodedata.normalize("NFKD", " ".join(name.split()).upper())
    return " ".join("".join(c for c in text if not unicodedata.combining(c)).split())


def normalize_requests(rows: DataFrame) -> DataFrame:
    """Sheet rows (any header spelling, ``row_number`` from 2) as typed request rows.

    Rows whose every cell is blank are dropped.  Raises when a required column is absent.
    """
    headers = {header_name(c): c for c in rows.columns if c != "row_number"}
    absent = sorted(set(fv.REQUEST_REQUIRED) - set(headers))
    if absent:
        raise ValueError("required columns absent: " + ", ".join(absent))
    filled = F.lit(False)
    for c in headers.values():
        filled = filled | (F.coalesce(F.col(c).cast("string"), F.lit("")) != "")
    columns = [F.col("row_number").cast("int").alias("row_number")]
    for header, name in _REQUEST_COLUMNS.items():
        raw = F.col(headers[header]).cast("string") if header in headers else F.lit("")
        if name == "valor":
            value = N.parse_request_number(raw)
        elif name == "tipo_exame":
            value = T.squash_lines(raw)
        else:
            value = T.squash(F.coalesce(raw, F.lit("")))
        columns.append(value.alias(name))
    return rows.filter(filled).select(*columns)


def validate_requests(rows: DataFrame) -> DataFrame:
    """Adds ``erro``: the first failed check of the row, null when it may be issued."""
    names = [(label, _REQUEST_COLUMNS[label]) for label in fv.REQUEST_NOT_BLANK]
    missing = F.array_compact(F.array(*[F.when(F.coalesce(F.col(c), F.lit("")) == "", F.lit(n)) for n, c in names]))
    error = (
        F.when(F.size(missing) > 0, F.concat(F.lit("campos obrigatorios vazios: "), F.array_join(missing, ", ")))
        .when(~N.is_valid_cpf("cpf"), "CPF invalido")
        .when(F.col("valor").isNull(), "VALOR invalido")
        .when(F.col("valor") <= 0, "VALOR deve ser maior que zero")
        .when(F.length("uf") != 2, "UF invalida")
        .when((F.coalesce("cep", F.lit("")) != "") & (F.length(T.digits("cep")) != 8), "CEP invalido")
    )
    return rows.withColumn("erro", error)


def select_requests(rows: DataFrame, row_number: int | None = None, all_rows: bool = False, limit: int | None = None) -> DataFrame:
    """One row by number, or all rows, optionally the first ``limit`` of them."""
    if (row_number is not None) == all_rows:
        raise ValueError("give either a row number or all_rows")
    if limit is not None and limit < 1:
        raise ValueError("limit must be positive")
    if row_number is not None:
        return rows.filter(F.col("row_number") == row_number)
    return rows if limit is None else rows.orderBy("row_number").limit(limit)


def request_hash(rows: DataFrame) -> Column:
    """Content hash of a request row, the key of the issuing ledger."""
    record = {c: F.col(c) for c in rows.columns if c not in ("erro", "row_hash")}
    record["valor"] = N.money_text("valor")
    ordered = F.struct(*[record[c].alias(c) for c in sorted(record)])
    return F.sha2(F.to_json(ordered, {"ignoreNullFields": "false"}), 256)


def unissued(rows: DataFrame, ledger: DataFrame) -> DataFrame:
    """Requests whose hash has no success in the ledger."""
    done = ledger.filter((F.col("status") == "success") & (F.coalesce("row_hash", F.lit("")) != ""))
    return rows.withColumn("row_hash", request_hash(rows)).join(
        done.select("row_hash").distinct(), "row_hash", "left_anti"
    )


def invoice_file_name(number: str, place: str, kind: str, patient: str) -> Column:
    stem = F.concat(
        T.safe_file_part(number), F.lit(" - "), T.safe_file_part(place), F.lit(", "), T.safe_file_part(kind), F.lit(" e "), T.safe_file_part(patient)
    )
    return F.concat(F.rtrim(T.cut(stem, fv.FILE_STEM_LIMIT)), F.lit(".pdf"))


def eligible_issuances(
    issues: DataFrame,
    requests: DataFrame,
    workflow: DataFrame,
    batch_id: int | None = None,
    request_ids: list[int] | None = None,
) -> DataFrame:
    """Pending issues of validated requests that were sent to issuing, with the request fields."""
    wanted = issues.filter(F.col("status") == "PENDENTE")
    if batch_id is not None:
        wanted = wanted.filter(F.col("lote_id") == batch_id)
    if request_ids is not None:
        wanted = wanted.filter(F.col("solicitacao_nota_id").isin(*request_ids))
    e = wanted.select(
        F.col("id").alias("emissao_id"),
        "lote_id",
        F.col("solicitacao_nota_id").alias("solicitacao_id"),
        "usuario_id",
        T.blank_to_null("cnpj_emissor").alias("_cnpj"),
    )
    s = requests.select(
        F.col("id").alias("solicitacao_id"),
        T.blank_to_null("cnpj_emissor").alias("_cnpj_pedido"),
        F.col("nm_paciente").alias("paciente"),
        "local",
        "tipo_atendimento",
        F.col("codigo_atendimento").alias("atendimento"),
        F.col("nr_cpf").alias("cpf"),
        F.col("valor_nota").alias("valor"),
        F.col("ds_endereco").alias("rua"),
        F.col("nr_endereco").alias("numero_casa"),
        F.col("nm_bairro").alias("bairro"),
        F.col("nr_cep").alias("cep"),
        F.col("ds_complemento").alias("complemento"),
        F.col("nr_fone").alias("telefone"),
        column_or_null(requests, ("cidade", "nm_cidade")).alias("cidade"),
        column_or_null(requests, ("uf", "sg_uf")).alias("uf"),
        F.col("procedimento").alias("tipo_exame"),
        F.col("data_criacao").alias("data"),
        "email",
    )
    ready = workflow.filter((F.col("validacao") == "VALIDADA") & (F.col("status") == "EMISSAO_SOLICITADA"))
    w = ready.select(F.col("solicitacao_nota_id").alias("solicitacao_id"))
    joined = e.join(s, "solicitacao_id").join(w, "solicitacao_id")
    return joined.withColumn("cnpj_emissor", F.coalesce("_cnpj", "_cnpj_pedido")).drop("_cnpj", "_cnpj_pedido")


def choose_issuer(df: DataFrame, payload: str = "cnpj_payload", default: str | None = None) -> DataFrame:
    """Adds ``cnpj`` (table, payload, default, in that order) and ``conflito_cnpj``."""
    own, given = N.cnpj("cnpj_emissor"), N.cnpj(payload)
    fallback = F.lit(default).cast("string")
    return df.withColumns(
        {"cnpj": F.coalesce(own, given, fallback), "conflito_cnpj": F.coalesce(own != given, F.lit(False))}
    )


def request_rows(eligible: DataFrame, default_city: str, default_state: str) -> DataFrame:
    """Table requests in the shape of :func:`normalize_requests`, with default city and state."""
    text = {name: T.squash(F.coalesce(F.col(name).cast("string"), F.lit(""))) for name in _REQUEST_COLUMNS.values()}
    text["cidade"] = F.coalesce(T.blank_to_null(text["cidade"]), F.lit(default_city))
    text["uf"] = F.upper(F.coalesce(T.blank_to_null(text["uf"]), F.lit(default_state)))
    text["valor"] = N.parse_request_number("valor")
    text["tipo_exame"] = T.squash_lines(F.col("tipo_exame"))
    columns = [F.col("solicitacao_id").cast("int").alias("row_number")]
    return eligible.select(*columns, *[value.alias(name) for name, value in text.items()])


def start_batches(batches: DataFrame, started: DataFrame, run_ts: Column) -> DataFrame:
    """Batches named in ``started`` (``id``, ``dag_run_id``) go to processing."""
    runs = started.select("id", F.col("dag_run_id").alias("_run"))
    hit = F.col("_run").isNotNull()
    now = D.local_time(run_ts)
    waiting = hit & F.col("status").isin("PENDENTE", "ERRO")
    return (
        batches.join(runs, "id", "left")
        .withColumns(
            {
                "airflow_disparado_em": F.when(hit, F.coalesce("airflow_disparado_em", now)).otherwise(F.col("airflow_disparado_em")),
                "erro_disparo": F.when(~hit, F.col("erro_disparo")),
                "status": F.when(waiting, "PROCESSANDO").otherwise(F.col("status")),
                "dag_run_id": F.coalesce("_run", "dag_run_id"),
            }
        )
        .select(*batches.columns)
    )


def apply_outcomes(
    issues: DataFrame, workflow: DataFrame, outcomes: DataFrame, run_ts: Column
) -> tuple[DataFrame, DataFrame]:
    """Apply (``emissao_id``, ``sucesso``, ``numero_nfse``, ``protocolo``, ``erro``) to both tables.

    Issues move only from processing, workflow rows only from the requested state.
    """
    result = outcomes.select(
        F.col("emissao_id").alias("id"),
        F.col("sucesso").alias("_ok"),
        F.col("numero_nfse").alias("_numero"),
        F.col("protocolo").alias("_protocolo"),
        T.cut("erro", fv.ERROR_TEXT_LIMIT).alias("_erro"),
    )
    joined = issues.join(result, "id", "left")
    now = D.local_time(run_ts)
    due = F.col("_ok").isNotNull() & (F.col("status") == "PROCESSANDO")
    good, bad = due & F.col("_ok"), due & ~F.col("_ok")
    changed = {
        "status": F.when(good, "EMITIDA").when(bad, "ERRO").otherwise(F.col("status")),
        "numero_nfse": F.when(good, F.col("_numero")).otherwise(F.col("numero_nfse")),
        "protocolo": F.when(good, F.col("_protocolo")).otherwise(F.col("protocolo")),
        "erro": F.when(bad, F.col("_erro")).when(~F.coalesce(good, F.lit(False)), F.col("erro")),
    }
    if "data_atualizacao" in issues.columns:
        changed["data_atualizacao"] = F.when(due, now).otherwise(F.col("data_atualizacao"))
    next_issues = joined.withColumns(changed).select(*issues.columns)

    touched = issues.select("id", "solicitacao_nota_id").join(result, "id").groupBy("solicitacao_nota_id").agg(
        F.bool_or("_ok").alias("_ok")
    )
    asked = F.col("_ok").isNotNull() & (F.col("status") == "EMISSAO_SOLICITADA")
    moved = {
        "status": F.when(asked & F.col("_ok"), "EMITIDA").when(asked, "ERRO_EMISSAO").otherwise(F.col("status"))
    }
    if "data_atualizacao" in workflow.columns:
        moved["data_atualizacao"] = F.when(asked, now).otherwise(F.col("data_atualizacao"))
    next_workflow = (
        workflow.join(touched, "solicitacao_nota_id", "left").withColumns(moved).select(*workflow.columns)
    )
    return next_issues, next_workflow


def outcome_events(issues: DataFrame, outcomes: DataFrame, run_id: str) -> DataFrame:
    """Audit rows to append, one per outcome."""
    joined = outcomes.join(issues.select(F.col("id").alias("emissao_id"), "solicitacao_nota_id", "usuario_id"), "emissao_id")
    done = F.concat(
        F.lit("NFS-e "), "numero_nfse", F.lit(f" emitida. dag_run_id={run_id}; pdf="), F.concat(F.lit("nfse-"), "numero_nfse", F.lit(".pdf"))
    )
    failed = F.concat(F.lit(f"Falha na emissao. dag_run_id={run_id}; erro="), "erro")
    return joined.select(
        "solicitacao_nota_id",
        "usuario_id",
        F.when(F.col("sucesso"), "NFSE_EMITIDA").otherwise("ERRO_EMISSAO").alias("tipo_acao"),
        T.cut(F.when(F.col("sucesso"), done).otherwise(failed), fv.EVENT_TEXT_LIMIT).alias("observacao"),
    )


def fail_batch(
    batches: DataFrame, issues: DataFrame, workflow: DataFrame, batch_id: int, run_id: str, error: str
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """A broken run: issues in work, their workflow rows and the batch itself become errors."""
    message = f"dag_run_id={run_id}; erro={error}"[: fv.ERROR_TEXT_LIMIT]
    hit = (F.col("lote_id") == batch_id) & (F.col("status") == "PROCESSANDO")
    next_issues = issues.withColumns(
        {"erro": F.when(hit, F.lit(message)).otherwise(F.col("erro")), "status": F.when(hit, "ERRO").otherwise(F.col("status"))}
    )
    due = (F.col("id") == batch_id) & (F.col("status") != "EMITIDA")
    next_batches = batches.withColumns(
        {
            "dag_run_id": F.when(due, F.lit(run_id)).otherwise(F.col("dag_run_id")),
            "erro_disparo": F.when(due, F.lit(message)).otherwise(F.col("erro_disparo")),
            "status": F.when(due, "ERRO").otherwise(F.col("status")),
        }
    )
    failed = next_issues.filter(
        (F.col("lote_id") == batch_id) & (F.col("status") == "ERRO") & (F.col("erro") == message)
    )
    return next_batches, next_issues, fail_workflow(workflow, failed)


def fail_workflow(workflow: DataFrame, failed_issues: DataFrame) -> DataFrame:
    """Requested workflow rows of failed issues become issuing errors."""
    marks = failed_issues.select("solicitacao_nota_id").distinct().withColumn("_falhou", F.lit(True))
    due = F.coalesce("_falhou", F.lit(False)) & (F.col("status") == "EMISSAO_SOLICITADA")
    return (
        workflow.join(marks, "solicitacao_nota_id", "left")
        .withColumn("status", F.when(due, "ERRO_EMISSAO").otherwise(F.col("status")))
        .select(*workflow.columns)
    )


def batch_status(issues: DataFrame) -> DataFrame:
    """Verdict and state counts of every batch."""
    counts = issues.groupBy("lote_id").agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(F.col("status") == s).alias(s.lower()) for s in ("ERRO", "EMITIDA", "PENDENTE", "PROCESSANDO")],
    )
    verdict = F.when(F.col("erro") > 0, "ERRO").when(F.col("emitida") == F.col("total"), "EMITIDA").otherwise("ERRO")
    return counts.withColumn("status_lote", verdict)


def error_digest(issues: DataFrame, n: int = fv.ERROR_DIGEST_ITEMS) -> DataFrame:
    """First ``n`` failed issues of each batch as one short text."""
    failed = issues.filter(F.col("status") == "ERRO")
    rank = F.row_number().over(W.partitionBy("lote_id").orderBy("id"))
    line = F.concat(F.lit("solicitacao="), F.col("solicitacao_nota_id").cast("string"), F.lit(": "), F.coalesce("erro", F.lit("None")))
    first = failed.withColumn("_rank", rank).filter(F.col("_rank") <= n)
    listed = first.groupBy("lote_id").agg(F.array_sort(F.collect_list(F.struct("id", line.alias("linha")))).alias("linhas"))
    return listed.select("lote_id", F.array_join(F.transform("linhas", lambda x: x["linha"]), "; ").alias("detalhes"))


def finish_batches(batches: DataFrame, issues: DataFrame, runs: DataFrame) -> DataFrame:
    """Write verdict and error text of the batches in ``runs`` (``id``, ``dag_run_id``)."""
    status = batch_status(issues).withColumnRenamed("lote_id", "id")
    digest = error_digest(issues).withColumnRenamed("lote_id", "id")
    known = runs.select("id", F.col("dag_run_id").alias("_run"))
    joined = batches.join(known, "id", "left").join(status, "id", "left").join(digest, "id", "left")
    hit = F.col("_run").isNotNull()
    zero = F.lit(0)
    open_text = F.concat(
        F.lit("lote terminou com "), F.coalesce("pendente", zero).cast("string"), F.lit(" item(ns) pendente(s) e "),
        F.coalesce("processando", zero).cast("string"), F.lit(" item(ns) em processamento."),
    )
    detail = F.when(F.col("erro") > 0, F.col("detalhes")).otherwise(open_text)
    verdict = F.coalesce("status_lote", F.lit("ERRO"))
    error = F.when(verdict != "EMITIDA", T.cut(F.concat(F.lit("dag_run_id="), "_run", F.lit("; "), detail), fv.ERROR_TEXT_LIMIT))
    return joined.withColumns(
        {
            "status": F.when(hit, verdict).otherwise(F.col("status")),
            "erro_disparo": F.when(hit, error).otherwise(F.col("erro_disparo")),
            "dag_run_id": F.coalesce("_run", "dag_run_id"),
        }
    ).select(*batches.columns)


def artifact_rows(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) from (``emissao_nfse_id``, ``numero_nfse``, ``content``); only PDF content passes."""
    number = T.squash(F.coalesce("numero_nfse", F.lit("")))
    good = number.rlike(r"\A[0-9]+\z") & (F.substring("content", 1, 4) == F.lit(fv.PDF_MAGIC.encode()))
    marked = files.withColumn("_ok", F.coalesce(good, F.lit(False)))
    rows = marked.filter("_ok").select(
        "emissao_nfse_id",
        F.concat(F.lit("nfse-"), number, F.lit(".pdf")).alias("nome_arquivo"),
        F.lit(fv.PDF_MIME).alias("tipo_mime"),
        F.col("content").alias("conteudo"),
        F.length("content").cast("bigint").alias("tamanho_bytes"),
        F.sha2("content", 256).alias("sha256"),
    )
    return rows, marked.filter("not _ok").select("emissao_nfse_id", "numero_nfse")


def upsert_artifacts(current: DataFrame, rows: DataFrame) -> DataFrame:
    return merge_by_key(current, rows, ["emissao_nfse_id"])
