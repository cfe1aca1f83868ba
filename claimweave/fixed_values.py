"""Word lists, labels, patterns and constants of the data contract.

Everything in this module is data that input files, stored tables or expected
results dictate.  Logic lives elsewhere and only refers to these names.
"""

# --- statement text files -------------------------------------------------
STATEMENT_OPERATOR_HEADER = "REGISTRO ANS#OPERADORA#CNPJ OPERADORA#"
STATEMENT_DETAIL_HEADER = "FATURA#LOTE#DATA ENVIO LOTE#NRO PROTOCOLO#"
STATEMENT_FIELD_COUNT = 21
STATEMENT_FILE_NAME = r"demonstrativo_conta_ipm_(\d{4})_(\d{2})\.txt"

# --- processes ------------------------------------------------------------
PROCESS_NUMBER = r"\b(P?\d{5,})\s*[/_]\s*(\d{4})\b"
PROCESS_STATUSES = (
    r"ABERTURA\s+REPROVADA|FINALIZADO|TRAMITANDO|RASCUNHO|CANCELADO|"
    r"DESARQUIVADO|ARQUIVADO"
)
STATUS_UNKNOWN = "DESCONHECIDO"
STATUS_FINAL = "FINALIZADO"
STATUS_OPEN = "TRAMITANDO"
REPORT_STATUSES = ("FINALIZADO", "TRAMITANDO")
REPORT_MIN_YEAR = 2024
PERIOD_MIN_DATE = "2024-01-01"
TYPE_LABELS = ("tipo de processo/assunto", "tipo/assunto", "assunto")
TYPE_STOP_LABELS = ("data de abertura", "motivo da finalizacao", "motivo")
TYPE_SKIPPED_LINES = ("numero", "atencao")
REASON_CUT = r"\s+VISUALIZAR\s+(?:MOVIMENTA\S*|PROCESSO)\b"
REASON_MORE = r"\s*\(ver\s+(?:menos|mais)\).*$"
REASON_QUOTES = " \"'“”‘’"
EDGE_PUNCTUATION = " :-–—"
KNOWN_PAGE_STREAK = 2

# --- document tree --------------------------------------------------------
SECTOR_SETTLEMENT = "ipm/saudecogestao"
SECTOR_PAYMENT = "ipm/nuexo"
SETTLEMENT_SPELLINGS = ("ipm/saudecogestao", "ipm/co-gestora", "ipm/cogestora")
PAYMENT_EXCLUDED_WORDS = (
    "certidao",
    "certidoes",
    "consulta",
    "regularidade",
    "cnd",
    "fgts",
    "crf",
)
SETTLEMENT_EXCLUDED_WORD = "despacho"
SETTLEMENT_EXCLUDED_STEM = r"^relatorio_\d+(?:_.*)?\z"
REPORT_FILE_NAME = r"^relatorio_(\d+)_\d+\.pdf\z"

# --- account reports ------------------------------------------------------
REPORT_LABELS = {
    "cd_remessa": ("remessa",),
    "nome_paciente": ("nome do paciente", "nome paciente", "paciente"),
    "numero_guia": ("numero da guia", "numero guia", "guia"),
    "numero_conta": ("numero da conta", "numero conta", "conta"),
    "cd_atendimento": ("codigo atendimento", "cod atendimento", "atendimento"),
    "competencia": ("competencia",),
    "valor": ("valor",),
}
REPORT_MONTH_LABEL = r"comp\S*?\s*:?[r]?\s*(0[1-9]|1[0-2]).(\d{4})\b"
REPORT_HEADER_X = (250.0, 360.0)
REPORT_HEADER_WORD = "at"
REPORT_TOTAL_WORD = "total"
REPORT_HEADER_GAP = 5.0
REPORT_ROW_TOLERANCE = 5.0
REPORT_COLUMN_X = {
    "numero_guia": (105.0, 162.0),
    "numero_conta": (162.0, 263.0),
    "cd_atendimento": (263.0, 299.0),
    "nome_paciente": (295.0, 442.0),
    "valor": (530.0, float("inf")),
}

# --- settlement documents -------------------------------------------------
SETTLEMENT_MARKERS = ("nome prestador", "cnpj", "numero processo", "competencia tms")
SETTLEMENT_LABELS = {
    "cnpj": ("cnpj", "cpf/cnpj"),
    "nome_prestador": ("nome prestador",),
    "numero_processo": ("numero processo", "numero processo origem"),
    "competencia_tms": ("competencia tms",),
    "competencia_producao": ("comp de producao",),
    "data_fechamento": ("dt fechamento",),
    "valor_informado": ("valor informado", "valor informado origem", "valor informado xml"),
    "valor_aprovado_producao": ("valor aprovado", "valor liberado"),
    "valor_glosado_producao": ("valor glosado",),
    "processo_recurso": ("numero processo recurso",),
}
SETTLEMENT_OPTIONAL_LABELS = ("processo_recurso",)
PROTOCOL_HEADER = {
    "nr": ("nr",),
    "valor_protocolo": ("valor protocolo",),
    "valor_glosado_protocolo": ("valor glosado", "valor gloado"),
    "valor_aprovado_protocolo": ("valor aprovado",),
}
PROTOCOL_ORIGIN_LABEL = "nr origem"
PROTOCOL_HEADER_ROWS = 4
LEGACY_MARKER = "resumo fechamento do processo"
LEGACY_PROVIDER = (
    r"(?md)^\s*(\d{6,})\s+(\d{1,2}/\d{4})\s+(\d{11,14})\s+(.+?)\s+\d{2}/\d{2}/\d{4}\s+"
    r"\d+\s+\d+\s+[0-9.,]+\s*$"
)
LEGACY_TOTALS = r"(?imd)^\s*TOTAL GERAL\s+\d+\s+([0-9.,]+)\s+([0-9.,]+)\s+([0-9.,]+)\s*$"
LEGACY_CLOSED = r"(?i)\bDATA\s*-\s*(\d{2}/\d{2}/\d{4})\b"
LEGACY_DENIED = r"(?i)\bGLOSA\s*:\s*R\$\s*([0-9.,]+)"

# --- payment documents ----------------------------------------------------
BANK_AGENCY_LABELS = (r"BANCO\s*/\s*AG[ÊE]NCIA", r"BANCO\s+E\s+AG[ÊE]NCIA")
ACCOUNT_LABELS = (r"CONTA\s+CORRENTE", r"\bCONTA\b")
ACCESS_KEY_LABELS = (
    r"CHAVE\s+DE\s+ACESSO\s+DA\s+NFS-?E",
    r"CHAVE\s+DE\s+ACESSO",
    r"C[ÓO]DIGO\s+DE\s+VERIFICA[ÇC][ÃA]O",
)
NEXT_LABEL = r"\s+(?:CONTA|BANCO|AG[ÊE]NCIA|FAVORECIDO|CPF\s*/\s*CNPJ|NIT)\s*:"
BANKS = {
    "santander": "Banco Santander",
    "bradesco": "Banco Bradesco",
    "itau": "Banco Itaú",
    "banco do brasil": "Banco do Brasil",
    "caixa economica": "Caixa Econômica Federal",
    "nubank": "Nubank",
}
INVOICE_WORDS_IN_NAME = ("nfs", "nota fiscal")
INVOICE_NAME_PREFIX = "nf_"
INVOICE_WORDS_IN_TEXT = ("nota fiscal", "nfs-e")
COMMITMENT_WORD_IN_NAME = "empenho"
COMMITMENT_WORD_IN_TEXT = "banco/agencia"
INVOICE_NUMBERS = (
    r"N[ÚU]MERO\s+DA\s+NFS-?E\s*:?[ \t\r\n]*(\d{1,20})\b",
    r"\bNFS-?E\s*(?:N[º°O])?\s*:?[ \t]*(\d{1,20})\b",
)
PROVIDER_SHEET = (
    r"PRESTADOR\s*/\s*FORNECEDOR[^\r\n]*CNPJ\s*/\s*CPF\s*/\s*NIF[^\r\n]*"
    r"\r?\n[ \t]*([0-9][0-9./\-]{10,24})"
)
PROVIDER_SECTION = r"\bPRESTADOR\b(.*?)(?:\bTOMADOR\b|\z)"
PROVIDER_ID = (
    r"(?:CPF\s*/\s*CNPJ|CNPJ\s*/\s*CPF(?:\s*/\s*NIF)?)"
    r"[ \t]*[:\-]?[ \t]*(?:\r?\n[ \t]*)?([0-9./\-]{11,25})"
)
PROVIDER_ID_ANYWHERE = (
    r"(?:CPF\s*/\s*CNPJ|CNPJ\s*/\s*CPF(?:\s*/\s*NIF)?)(?:\s*\([^)]*\))?"
    r"[ \t]*[:\-]?[ \t]*(?:\r?\n[ \t]*)?([0-9./\-]{11,25})"
)

# --- request rows ---------------------------------------------------------
REQUEST_REQUIRED = (
    "PACIENTE",
    "LOCAL",
    "TIPO ATENDIMENTO",
    "CPF",
    "VALOR",
    "RUA",
    "NUMERO CASA",
    "BAIRRO",
    "CIDADE",
    "UF",
    "TIPO DE EXAME",
    "EMAIL",
)
REQUEST_OPTIONAL = ("ATENDIMENTO", "DATA", "CEP", "COMPLEMENTO", "TELEFONE")
REQUEST_NOT_BLANK = (
    "PACIENTE",
    "LOCAL",
    "TIPO ATENDIMENTO",
    "CPF",
    "CIDADE",
    "UF",
    "TIPO DE EXAME",
)
MONTH_NAMES = (
    "janeiro",
    "fevereiro",
    "março",
    "abril",
    "maio",
    "junho",
    "julho",
    "agosto",
    "setembro",
    "outubro",
    "novembro",
    "dezembro",
)
FILE_NAME_FALLBACK = "SEM INFORMACAO"
FILE_STEM_LIMIT = 230

# --- denial linking -------------------------------------------------------
PAYER_CODE = 10
LOCAL_ZONE = "America/Sao_Paulo"
LINKED_STATUS_PREFIX = "ASSOCIADO"
DIRECT_RULE = (1, "relatorio_hpc_guia_beneficiario_servico")
# priority, criterion, month of, guide, service equals, tuss must be filled, value
FALLBACK_RULES = (
    (11, "relatorio_hpc_competencia_guia_servico_carteira", "competencia", True, "pf", False, False),
    (12, "relatorio_hpc_competencia_servico_carteira", "competencia", False, "pf", False, False),
    (13, "relatorio_hpc_competencia_tuss_carteira_valor", "competencia", False, "tuss", True, True),
    (14, "relatorio_hpc_lancamento_servico_carteira", "lancamento", False, "pf_tuss", False, False),
    (15, "relatorio_hpc_competencia_servico_valor", "competencia", False, "tuss_pf", False, True),
    (16, "relatorio_hpc_atendimento_guia_servico_valor", "atendimento", True, "tuss_pf", False, True),
    (17, "relatorio_hpc_lancamento_servico_carteira_valor", "lancamento", False, "pf", False, True),
)
LEGACY_RULES = (
    (21, "cogestao_competencia_guia_servico_carteira", "competencia", True, "pf", False, False),
    (22, "cogestao_competencia_servico_carteira", "competencia", False, "pf", False, False),
    (23, "cogestao_competencia_tuss_carteira", "competencia", False, "tuss", True, True),
    (24, "cogestao_lancamento_coalesce_servico_carteira", "lancamento", False, "pf_tuss", False, False),
    (25, "cogestao_competencia_coalesce_servico_valor", "competencia", False, "tuss_pf", False, True),
    (26, "cogestao_atendimento_guia_coalesce_servico_valor", "atendimento", True, "tuss_pf", False, True),
    (27, "cogestao_lancamento_pro_fat_carteira_valor", "lancamento", False, "pf", False, True),
)
ACCOUNT_RULES = (
    (1, "remessa_conta_atendimento"),
    (2, "remessa_conta_guia"),
    (3, "remessa_atendimento_guia"),
    (4, "remessa_conta"),
)

# --- denial register defaults --------------------------------------------
DEFAULT_ATTENDANCE_TYPE = "Externo"
DEFAULT_CODE = "-"
DEFAULT_PAYER = "IPM"
DEFAULT_PROVIDER = "Prestador não informado"
DEFAULT_GROUP = "Grupo não informado"
DEFAULT_ITEM = "Item do demonstrativo IPM"
DENIED_VALUE_TEXT = ". Valor glosado na origem: R$ "
ORIGIN_TRIAGE = "triagem"
ORIGIN_CONCILIATION = "conciliacao"
LEGACY_LOAD_ID = "legacy_migration"

# --- issuance -------------------------------------------------------------
PDF_MIME = "application/pdf"
PDF_MAGIC = "%PDF"
ERROR_TEXT_LIMIT = 1000
EVENT_TEXT_LIMIT = 500
ERROR_DIGEST_ITEMS = 5

# --- spellings of dates and months (fixed values) ---
DAY_MONTH_YEAR = r"\A(\d{1,2})/(\d{1,2})/(\d{4})\z"
DAY_MONTH_SHORT_YEAR_2000 = r"\A(\d{1,2})/(\d{1,2})/([0-5]\d|6[0-8])\z"
DAY_MONTH_SHORT_YEAR_1900 = r"\A(\d{1,2})/(\d{1,2})/(69|[7-9]\d)\z"
YEAR_MONTH_DAY = r"\A(\d{4})-(\d{1,2})-(\d{1,2})\z"
WHOLE_DATE = r"\A(\d{1,2}/\d{1,2}/\d{4}|\d{4}-\d{1,2}-\d{1,2})\z"
MONTH_YEAR = r"\A(\d{1,2})/(\d{4})\z"
YEAR_MONTH = r"\A(\d{4})-(\d{1,2})\z"
NAMED_MONTH = r"\A([A-Za-zÀ-ÿ]+),?\s+(\d{4})\z"
REFERENCE_MONTH = r"\A(0[1-9]|1[0-2])/(\d{4})\z"
DOCUMENT_MONTH = r"\b(0?[1-9]|1[0-2])[/\-](\d{4})\b"
XML_YEAR_MONTH = r"\b(\d{4})-(\d{1,2})(?:-\d{1,2})?\b"
XML_MONTH_YEAR = r"\b(\d{1,2})/(\d{4})\b"
XML_COMPACT_MONTH = r"\A(\d{4})(\d{2})(?:\d{2})?\z"

# --- invoice XML: output column -> alternative element paths, in order ----
INVOICE_NODE_TAGS = ("CompNfse", "Nfse", "InfNfse")
_INF = "Nfse/InfNfse"
_DECL = "Nfse/InfNfse/DeclaracaoPrestacaoServico/InfDeclaracaoPrestacaoServico"
_SERV = (f"{_INF}/Servico", f"{_DECL}/Servico")
INVOICE_PATHS = {
    "codigo_status_nfse": (f"{_INF}/Status", "InfNfse/Status"),
    "data_hora": (f"{_INF}/DataEmissao", "InfNfse/DataEmissao", "DataHora", "DataHoraRecebimento"),
    "quantidade_rps_lote": ("LoteRps/QuantidadeRps", "QuantidadeRps"),
    "numero_rps": (f"{_DECL}/Rps/IdentificacaoRps/Numero", "IdentificacaoRps/Numero"),
    "serie_rps": (f"{_DECL}/Rps/IdentificacaoRps/Serie", "IdentificacaoRps/Serie"),
    "informacoes_adicionais": (f"{_INF}/OutrasInformacoes", "OutrasInformacoes"),
    "codigo_item_lista_servico": tuple(f"{p}/ItemListaServico" for p in _SERV),
    "codigo_cnae": tuple(f"{p}/CodigoCnae" for p in _SERV),
    "codigo_tributacao": tuple(f"{p}/CodigoTributacaoMunicipio" for p in _SERV),
    "aliquota_xml": tuple(f"{p}/Valores/Aliquota" for p in _SERV),
    "discriminacao": tuple(f"{p}/Discriminacao" for p in _SERV),
    "codigo_municipio_servico": (
        f"{_INF}/Servico/CodigoMunicipio",
        f"{_INF}/Servico/MunicipioIncidencia",
        f"{_DECL}/Servico/CodigoMunicipio",
        f"{_DECL}/Servico/MunicipioIncidencia",
    ),
    "prestador_inscricao_municipal": (
        f"{_INF}/PrestadorServico/IdentificacaoPrestador/InscricaoMunicipal",
        f"{_DECL}/Prestador/InscricaoMunicipal",
    ),
    "prestador_razao_social": (f"{_INF}/PrestadorServico/RazaoSocial",),
    "prestador_nome_fantasia": (f"{_INF}/PrestadorServico/NomeFantasia",),
    "prestador_cnpj": (
        f"{_INF}/PrestadorServico/IdentificacaoPrestador/Cnpj",
        f"{_INF}/PrestadorServico/IdentificacaoPrestador/CpfCnpj/Cnpj",
        f"{_DECL}/Prestador/CpfCnpj/Cnpj",
    ),
    "prestador_cpf": (
        f"{_INF}/PrestadorServico/IdentificacaoPrestador/Cpf",
        f"{_INF}/PrestadorServico/IdentificacaoPrestador/CpfCnpj/Cpf",
        f"{_DECL}/Prestador/CpfCnpj/Cpf",
    ),
    "prestador_endereco": (f"{_INF}/PrestadorServico/Endereco/Endereco",),
    "prestador_numero_endereco": (f"{_INF}/PrestadorServico/Endereco/Numero",),
    "prestador_complemento_endereco": (f"{_INF}/PrestadorServico/Endereco/Complemento",),
    "prestador_bairro": (f"{_INF}/PrestadorServico/Endereco/Bairro",),
    "prestador_codigo_municipio": (f"{_INF}/PrestadorServico/Endereco/CodigoMunicipio",),
    "prestador_uf": (f"{_INF}/PrestadorServico/Endereco/Uf",),
    "prestador_cep": (f"{_INF}/PrestadorServico/Endereco/Cep",),
    "prestador_email": (f"{_INF}/PrestadorServico/Contato/Email",),
    "prestador_telefone": (f"{_INF}/PrestadorServico/Contato/Telefone",),
    "tomador_cpf": (
        f"{_INF}/TomadorServico/IdentificacaoTomador/CpfCnpj/Cpf",
        f"{_DECL}/Tomador/IdentificacaoTomador/CpfCnpj/Cpf",
    ),
    "tomador_cnpj": (
        f"{_INF}/TomadorServico/IdentificacaoTomador/CpfCnpj/Cnpj",
        f"{_DECL}/Tomador/IdentificacaoTomador/CpfCnpj/Cnpj",
    ),
    "tomador_indicador_cpf_cnpj": (
        f"{_INF}/TomadorServico/IdentificacaoTomador/CpfCnpj/IndicadorCpfCnpj",
        f"{_DECL}/Tomador/IdentificacaoTomador/CpfCnpj/IndicadorCpfCnpj",
    ),
    "tomador_razao_social": (f"{_INF}/TomadorServico/RazaoSocial", f"{_DECL}/Tomador/RazaoSocial"),
    "tomador_endereco": (f"{_INF}/TomadorServico/Endereco/Endereco", f"{_DECL}/Tomador/Endereco/Endereco"),
    "tomador_numero_endereco": (f"{_INF}/TomadorServico/Endereco/Numero", f"{_DECL}/Tomador/Endereco/Numero"),
    "tomador_complemento_endereco": (
        f"{_INF}/TomadorServico/Endereco/Complemento",
        f"{_DECL}/Tomador/Endereco/Complemento",
    ),
    "tomador_bairro": (f"{_INF}/TomadorServico/Endereco/Bairro", f"{_DECL}/Tomador/Endereco/Bairro"),
    "tomador_codigo_municipio": (
        f"{_INF}/TomadorServico/Endereco/CodigoMunicipio",
        f"{_DECL}/Tomador/Endereco/CodigoMunicipio",
    ),
    "tomador_uf": (f"{_INF}/TomadorServico/Endereco/Uf", f"{_DECL}/Tomador/Endereco/Uf"),
    "tomador_cep": (f"{_INF}/TomadorServico/Endereco/Cep", f"{_DECL}/Tomador/Endereco/Cep"),
    "tomador_email": (f"{_INF}/TomadorServico/Contato/Email", f"{_DECL}/Tomador/Contato/Email"),
    "tomador_telefone": (f"{_INF}/TomadorServico/Contato/Telefone", f"{_DECL}/Tomador/Contato/Telefone"),
    "codigo_obra": (f"{_DECL}/ConstrucaoCivil/CodigoObra", "ConstrucaoCivil/CodigoObra"),
    "codigo_art": (f"{_DECL}/ConstrucaoCivil/Art", "ConstrucaoCivil/Art"),
    "numero_lote_rps": ("LoteRps/NumeroLote", "NumeroLote"),
    "protocolo_recebimento_rps": ("Protocolo", "NumeroProtocolo"),
    "codigo_situacao_lote_rps": ("Situacao", "CodigoSituacaoLoteRps"),
    "codigo_mensagem_retorno": ("MensagemRetorno/Codigo", "Codigo"),
    "motivo_cancelamento_nfse": ("Cancelamento/Motivo", "MotivoCancelamento"),
    "cancelamento_codigo": (
        "Cancelamento/Confirmacao/Pedido/InfPedidoCancelamento/CodigoCancelamento",
        "CodigoCancelamento",
    ),
    "cancelamento_data_hora": ("Cancelamento/Confirmacao/DataHora", "DataHoraCancelamento"),
    "numero_nfse": (f"{_INF}/Numero", "InfNfse/Numero"),
    "competencia_nfse": (
        f"{_INF}/Competencia",
        "InfNfse/Competencia",
        f"{_DECL}/Competencia",
        "Competencia",
    ),
    "codigo_verificacao_nfse": (f"{_INF}/CodigoVerificacao", "InfNfse/CodigoVerificacao"),
    "codigo_status_rps": (f"{_DECL}/Rps/Status", "Rps/Status"),
    "codigo_natureza_operacao": (
        f"{_INF}/NaturezaOperacao",
        f"{_DECL}/Servico/NaturezaOperacao",
        "NaturezaOperacao",
    ),
    "codigo_regime_especial_tributacao": (
        f"{_INF}/RegimeEspecialTributacao",
        f"{_DECL}/RegimeEspecialTributacao",
    ),
    "codigo_tipo_rps": (f"{_DECL}/Rps/IdentificacaoRps/Tipo", "IdentificacaoRps/Tipo"),
    "intermediario_cpf": (
        f"{_DECL}/Intermediario/CpfCnpj/Cpf",
        f"{_DECL}/Intermediario/IdentificacaoIntermediario/CpfCnpj/Cpf",
    ),
    "intermediario_cnpj": (
        f"{_DECL}/Intermediario/CpfCnpj/Cnpj",
        f"{_DECL}/Intermediario/IdentificacaoIntermediario/CpfCnpj/Cnpj",
    ),
    "intermediario_inscricao_municipal": (
        f"{_DECL}/Intermediario/InscricaoMunicipal",
        f"{_DECL}/Intermediario/IdentificacaoIntermediario/InscricaoMunicipal",
    ),
    "intermediario_razao_social": (f"{_DECL}/Intermediario/RazaoSocial",),
    "orgao_gerador_codigo_municipio": (
        f"{_INF}/OrgaoGerador/CodigoMunicipio",
        "OrgaoGerador/CodigoMunicipio",
    ),
    "orgao_gerador_uf": (f"{_INF}/OrgaoGerador/Uf", "OrgaoGerador/Uf"),
    "valor_servicos": tuple(f"{p}/Valores/ValorServicos" for p in _SERV),
    "valor_deducoes": tuple(f"{p}/Valores/ValorDeducoes" for p in _SERV),
    "valor_pis": tuple(f"{p}/Valores/ValorPis" for p in _SERV),
    "valor_cofins": tuple(f"{p}/Valores/ValorCofins" for p in _SERV),
    "valor_inss": tuple(f"{p}/Valores/ValorInss" for p in _SERV),
    "valor_ir": tuple(f"{p}/Valores/ValorIr" for p in _SERV),
    "valor_csll": tuple(f"{p}/Valores/ValorCsll" for p in _SERV),
    "outras_retencoes": tuple(f"{p}/Valores/OutrasRetencoes" for p in _SERV),
    "iss_retido": tuple(f"{p}/Valores/IssRetido" for p in _SERV),
    "valor_iss": tuple(f"{p}/Valores/ValorIss" for p in _SERV),
    "valor_iss_retido": tuple(f"{p}/Valores/ValorIssRetido" for p in _SERV),
    "desconto_incondicionado": tuple(f"{p}/Valores/DescontoIncondicionado" for p in _SERV),
    "desconto_condicionado": tuple(f"{p}/Valores/DescontoCondicionado" for p in _SERV),
    "base_calculo": (
        f"{_INF}/Servico/Valores/BaseCalculo",
        f"{_INF}/ValoresNfse/BaseCalculo",
        "ValoresNfse/BaseCalculo",
    ),
    "valor_liquido_nfse": (
        f"{_INF}/Servico/Valores/ValorLiquidoNfse",
        f"{_INF}/ValoresNfse/ValorLiquidoNfse",
        "ValoresNfse/ValorLiquidoNfse",
    ),
}
# output column -> element names searched at any depth, first in document order
INVOICE_NAMES = {
    "identificacao_sim_nao": ("IdentificacaoSimNao", "SimNao"),
    "valor_booleano": ("true", "false"),
    "disponibilidade_nfse": ("Disponibilidade", "DisponibilidadeNfse"),
    "descricao_tributo": ("DescricaoTributo", "DescricaoDoTributo"),
}
