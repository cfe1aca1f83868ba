"""Explicit schemas of every stored or landed table."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructType,
    TimestampNTZType,
    TimestampType,
)

_TYPES: dict[str, DataType] = {
    "string": StringType(),
    "bigint": LongType(),
    "int": IntegerType(),
    "double": DoubleType(),
    "boolean": BooleanType(),
    "binary": BinaryType(),
    "date": DateType(),
    "timestamp": TimestampType(),
    "timestamp_ntz": TimestampNTZType(),
    "decimal(18,2)": DecimalType(18, 2),
    "decimal(18,4)": DecimalType(18, 4),
}


def _schema(columns: str, **nested: DataType) -> StructType:
    """``name type, name type``; nested columns are given by keyword and come last."""
    schema = StructType()
    for column in columns.split(", "):
        name, kind = column.split(" ")
        schema = schema.add(name, _TYPES[kind])
    for name, kind in nested.items():
        schema = schema.add(name, kind)
    return schema


STATEMENT_ROWS = _schema(
    "id_registro string, referencia date, cnpj_operadora string, numero_lote string, data_envio_lote date, "
    "numero_protocolo string, valor_protocolo decimal(18,2), valor_glosa_protocolo decimal(18,2), "
    "numero_guia_senha string, data_realizacao date, descricao_servico string, codigo_tabela string, "
    "codigo_servico string, grau_participacao string, quantidade_executada decimal(18,4), "
    "valor_processado decimal(18,2), valor_liberado decimal(18,2), valor_glosa decimal(18,2), "
    "codigo_glosa string, nome_beneficiario string, codigo_beneficiario string"
)
ASSOCIATION = _schema(
    "id_registro string, referencia date, numero_lote string, numero_protocolo string, "
    "valor_protocolo decimal(18,2), valor_glosa_protocolo decimal(18,2), numero_guia_senha string, "
    "data_realizacao date, descricao_servico string, codigo_tabela string, codigo_servico string, "
    "quantidade_executada decimal(18,4), valor_processado decimal(18,2), valor_liberado decimal(18,2), "
    "valor_glosa decimal(18,2), codigo_glosa string, nome_beneficiario string, codigo_beneficiario string, "
    "cogestao_id_registro string, numero_processo string, competencia_producao string, "
    "valor_protocolo_cogestao decimal(18,2), status_associacao string, candidatos_associacao string"
)
MANUAL_REMITTANCES = _schema("numero_processo string, competencia_producao string, nr string, cd_remessa bigint")
REMITTANCE_TOTALS = _schema(
    "cd_remessa bigint, nm_convenio string, cnpj_convenio string, competencia string, valor_total decimal(18,2)"
)
HOSPITAL_ITEMS = _schema(
    "cd_remessa bigint, cd_reg bigint, cd_lancamento bigint, cd_atendimento bigint, cd_paciente bigint, "
    "nm_paciente string, cd_prestador bigint, nm_prestador string, cd_convenio bigint, cnpj_convenio string, "
    "nm_convenio string, tp_atendimento string, nr_guia string, nr_carteira string, cd_pro_fat string, "
    "cd_tuss string, descricao string, dt_atendimento timestamp_ntz, dt_alta timestamp_ntz, dt_competencia date, "
    "dt_lancamento timestamp_ntz, qt_lancamento decimal(18,4), vl_total_conta decimal(18,2), cd_gru_fat bigint, "
    "ds_gru_fat string, cd_gru_pro bigint, ds_gru_pro string"
)
REPORT_ROWS = _schema(
    "id_registro string, numero_processo string, status_processo string, documento_id string, "
    "documento_nome string, pagina_pdf bigint, cd_remessa bigint, nome_paciente string, numero_guia string, "
    "numero_conta string, cd_atendimento bigint, competencia date, valor decimal(18,2), extraido_em timestamp"
)
PROCESSES = _schema(
    "numero_processo string, status_processo string, tipo_processo_assunto string, data_abertura date, "
    "motivo_finalizacao string, url_visualizacao string, detalhes_finalizados_extraidos boolean, extraido_em timestamp"
)
PROCESS_HISTORY = _schema("id_status string, numero_processo string, status_processo string, observado_em timestamp")
SETTLEMENTS = _schema(
    "id_registro string, cnpj string, nome_prestador string, numero_processo string, competencia_tms string, "
    "competencia_producao string, data_fechamento date, valor_informado decimal(18,2), "
    "valor_aprovado_producao decimal(18,2), valor_glosado_producao decimal(18,2), nr string, nr_origem string, "
    "processo_recurso string, valor_protocolo decimal(18,2), valor_aprovado_protocolo decimal(18,2), "
    "valor_glosado_protocolo decimal(18,2), processo_origem string, documento_id string, documento_nome string, "
    "pagina_pdf bigint"
)
COMMITMENTS = _schema(
    "id_registro string, numero_processo string, documento_id string, documento_nome string, banco string, "
    "codigo_conta string, codigo_agencia string, conta string"
)
PROVIDER_INVOICES = _schema(
    "id_registro string, numero_processo string, documento_id string, documento_nome string, numero_nfse string, "
    "chave_acesso_nfse string, cnpj_cpf_nif_prestador string"
)
PROCESS_CARDS = _schema(
    "numero string, cabecalho string, texto string, tipo string, data string, motivo string, href string",
    linhas=ArrayType(StringType()),
)
DOCUMENT_TREE = _schema(
    "numero_processo string",
    setores=ArrayType(_schema("setor string", documentos=ArrayType(_schema("id string, nome string")))),
)
PAGE_TABLES = _schema(
    "numero_processo string, documento_id string, documento_nome string, page int, text string",
    tables=ArrayType(ArrayType(ArrayType(StringType()))),
)
PAGE_WORDS = _schema(
    "numero_processo string, documento_id string, documento_nome string, page int, height double, text string",
    words=ArrayType(_schema("text string, x0 double, top double")),
)
LANDED_FILES = _schema("path string, modificationTime timestamp, length bigint, content binary")
REGISTER = _schema(
    "id bigint, codigo_paciente bigint, nm_paciente string, cd_remessa bigint, cd_atendimento bigint, conta bigint, "
    "cd_prestador bigint, cd_convenio bigint, tp_atendimento string, procedimento string, convenio string, "
    "guia string, prestador string, data_atendimento timestamp_ntz, valor decimal(18,2), "
    "processo_controle_fatura_gab string, processo_recurso string, data_glosa date, motivo_glosa string, "
    "descricao_glosa string, qtd_recursado decimal(18,4), valor_recursado decimal(18,2), dt_recurso date, "
    "dt_pagamento date, dt_recebimento date, valor_recebido decimal(18,2), qtd_recebida decimal(18,4), "
    "observacao_recebimento string, cd_lancamento bigint, qtd_registro decimal(18,4), descricao_item string, "
    "data_alta timestamp_ntz, data_lancamento timestamp_ntz, cd_gru_pro bigint, ds_gru_pro string, "
    "cd_gru_fat bigint, ds_gru_fat string, cd_tuss string, conciliacao_remessa_id bigint, origem_registro string, "
    "sn_glosado string, sn_ativo string"
)
TRACKING = _schema(
    "id_registro string, registro_glosa_id bigint, criterio_correspondencia string, data_importacao timestamp_ntz"
)
LEDGER = _schema(
    "timestamp string, status string, row_hash string, source_row bigint, numero_nfse string, pdf_path string, "
    "paciente string, cpf string"
)
