"""Declared contract of the billing extract and of the domain tables."""

from __future__ import annotations

import re
from dataclasses import dataclass

# File header, engine column and declared type, in file order.
# string(n) is the longest text the raw table accepts.  line_no is wider than
# a 32-bit integer so that one load may hold more than 2^31 lines.
_DECLARED = [
    ("Ordem", "line_no", "bigint"),
    ("MES_COMPETENCIA", "billing_month", "string(6)"),
    ("MES_REFERENCIA", "reference_month", "string(6)"),
    ("NOME", "customer_name", "string(255)"),
    ("CPF", "person_tax_id", "string(14)"),
    ("CNPJ", "company_tax_id", "string(18)"),
    ("MUNICIPIO", "municipality", "string(150)"),
    ("LOCALIDADE", "locality", "string(150)"),
    ("ENDERECO", "street", "string(255)"),
    ("NUMERO", "house_number", "string(50)"),
    ("COMPLEMENTO", "complement", "string(255)"),
    ("CEP", "postal_code", "string(15)"),
    ("BAIRRO", "district", "string(150)"),
    ("CALENDARIO_FABRICA", "reading_calendar", "string(10)"),
    ("LONGITUDE", "longitude", "decimal(18,12)"),
    ("LATITUDE", "latitude", "decimal(18,12)"),
    ("CLASSE_PRINCIPAL", "consumption_class", "string(100)"),
    ("SUBCLASSE", "consumption_subclass", "string(100)"),
    ("CATEGORIA_TARIFA", "tariff_category", "string(50)"),
    ("DATA_LIGACAO_CC", "connected_on", "date"),
    ("STATUS_COMERCIAL", "commercial_status", "string(10)"),
    ("CONTA_CONTRATO", "contract_account", "string(20)"),
    ("INSTALACAO", "installation", "string(20)"),
    ("ETAPA", "reading_stage", "string(10)"),
    ("GRUPO", "supply_group", "string(10)"),
    ("CLIENTE_LIVRE", "free_customer", "string(10)"),
    ("FASE", "phase", "string(10)"),
    ("PERIMETRO", "perimeter", "string(10)"),
    ("MICRO_GERADOR", "micro_generator", "string(10)"),
    ("IRRIGANTE", "irrigator", "string(10)"),
    ("MOTIVO_BLOQUEIO_CONTRATO", "block_reason", "string(255)"),
    ("CONTRATO_ATIVO", "contract_active", "string(5)"),
    ("MEIO_PAGAMENTO", "payment_channel", "string(10)"),
    ("DOCUMENTO_IMPRESSAO", "print_document", "string(30)"),
    ("FATURA", "bill_number", "string(30)"),
    ("CNR", "cnr", "string(30)"),
    ("RECEITA_BANDEIRAS", "flag_revenue", "decimal(18,2)"),
    ("CONSUMO_FATURADO", "billed_kwh", "decimal(18,6)"),
    ("CONSUMO_MEDIDO", "measured_kwh", "decimal(18,6)"),
    ("DATA_VENCIMENTO_ORIGINAL", "due_on", "date"),
    ("DATA_PAGAMENTO", "paid_on", "date"),
    ("INICIO_CALCULO", "cycle_start", "date"),
    ("FIM_CALCULO", "cycle_end", "date"),
    ("QUANTIDADE_DIAS", "cycle_days", "int"),
    ("CANCELAMENTO", "cancelled", "string(10)"),
    ("REFATURAMENTO", "rebilled", "string(10)"),
    ("DATA_REFATURAMENTO", "rebilled_on", "date"),
    ("TARIFA", "tariff", "decimal(18,8)"),
    ("PRECO", "price", "decimal(18,8)"),
    ("PIS", "tax_pis", "decimal(18,2)"),
    ("COFINS", "tax_cofins", "decimal(18,2)"),
    ("ICMS", "tax_icms", "decimal(18,2)"),
    ("RECEITA_CONSUMO_FATURADO", "consumption_revenue", "decimal(18,2)"),
    ("VALOR_FATURA", "bill_amount", "decimal(18,2)"),
    ("VLR_ARRECADADO", "paid_amount", "decimal(18,2)"),
    ("SITUACAO", "bill_status", "string(20)"),
    ("VALOR_FATURA_SUB", "substitute_amount", "decimal(18,2)"),
    ("CIP", "levy", "decimal(18,2)"),
    ("CIP_SUB", "substitute_levy", "decimal(18,2)"),
]

# Headers that may be neither null nor blank, in reporting order.
REQUIRED_HEADERS = [
    "MES_COMPETENCIA",
    "FATURA",
    "VALOR_FATURA",
    "DATA_VENCIMENTO_ORIGINAL",
    "MUNICIPIO",
    "CLASSE_PRINCIPAL",
]

# Message formats stored with rejected rows and failed loads.
MISSING_REASON = "Campos obrigatórios nulos: [{}]"
HEADER_VALID = "Schema validado com sucesso: {} colunas"
HEADER_UNREADABLE = "Não foi possível ler o CSV para validação de schema: {}"
HEADER_INVALID = "Schema inválido: {} colunas faltando, {} colunas extras. Faltando: {}. Extras: {}"

# Text that a flag column uses for "yes".
YES_WORDS = ["S", "SIM", "1", "TRUE", "T"]
YES_LETTER = "S"

# Consumption classes with their subclasses.
_COMMERCIAL = [
    "Comerc. Administração Condominial",
    "Comerc. Associação e Entidades Filant.",
    "Comerc. Iluminação em Rodovia",
    "Comerc. Outros Serviços e Atividades",
    "Comerc. Semáforos, Radares e Câmeras",
    "Comerc. Serv. Comunicações e Telecom",
    "Comerc. Templos Religiosos",
    "Comercial",
]
SUBCLASSES = {
    "Comercial, Serviços e Outras A": _COMMERCIAL,
    "Comercial, Servicos e Outras A": _COMMERCIAL,
    "Consumo Próprio": [
        "Consumo Próprio - Canteiro de Obras",
        "Consumo Próprio - Escritórios",
        "Consumo Próprio - Rec veículos elétricos",
        "Consumo Próprio - Sub-Estação",
        "Consumo Próprio - Usinas",
    ],
    "Industrial": ["Industrial", "Industrial B-Optante"],
    "Poder Publico": [
        "Poder Publico Federal",
        "Poder Publico Estadual B-Optante",
        "Poder Público Estadual",
        "Residencial Pleno",
        "Poder Público Municipal",
        "Poder Público Municipal B-Optante",
        "Poder Publico Federal B-Optante",
    ],
    "Residencial": [
        "Residencial Pleno",
        "Resid. Baixa Renda",
        "Resid. Baixa Renda Indígena",
        "Rural B-Optante",
        "Rural Residencial Rural",
        "Rural Agropecuária",
        "Resid. Baixa Renda BPC",
        "Resid. Baixa Renda Multifamiliar",
        "Resid. Baixa Renda Quilombola",
    ],
    "Rural": [
        "Rural Agropecuária",
        "Rural Residencial Rural",
        "Rural Coletividade Rural",
        "Agroindustrial",
        "Rural Serviço Público de Irrigação Rural",
        "Rural Escola Agrotécnica",
        "Rural Agropecuária Urbana",
    ],
    "Serviço Público": [
        "Serviço Público Água Esgoto e Saneamento",
        "Serviço Público B-Optante",
        "Serviço Público Resíduo B-Optante",
        "Serviço Público Tração Elétrica",
        "Serviço Público AES B-Optante",
    ],
}

# The other domain tables.
COMMERCIAL_STATUS = [("LG", "Ligado"), ("BL", "Bloqueado"), ("DS", "Desligado")]
ENTITY_TYPES = [("MUNICIPIO", "Município"), ("DISTRIBUIDORA", "Distribuidora")]
OPINION_STATUS = ["AGUARDANDO PARECER", "ACEITO", "RECUSADO"]
PERSON, COMPANY = "PF", "PJ"
DISTRIBUTOR = "DISTRIBUIDORA_PADRAO"


@dataclass(frozen=True)
class Column:
    """One column of the extract."""

    header: str
    name: str
    declared: str

    @property
    def kind(self) -> str:
        return self.declared.split("(")[0]

    @property
    def max_length(self) -> int:
        return int(re.search(r"\d+", self.declared).group())

    @property
    def spark_type(self) -> str:
        return "string" if self.kind == "string" else self.declared


COLUMNS = [Column(*row) for row in _DECLARED]
HEADERS = [c.header for c in COLUMNS]
NAMES = [c.name for c in COLUMNS]
BY_HEADER = {c.header: c for c in COLUMNS}
REQUIRED = [BY_HEADER[h] for h in REQUIRED_HEADERS]


@dataclass(frozen=True)
class Terms:
    """Vocabulary of the control and trial tables."""

    control: str
    treatment: str
    no_fault: str
    connection: str
    file_missing: str
    schema: str
    null_data: str
    no_mechanism: str
    retry: str
    fallback: str
    schema_check: str
    quarantine: str
    running: str
    success: str
    error: str


# The vocabulary of the published records, and an English one.
PUBLISHED_TERMS = Terms(
    control="BASELINE", treatment="TRATAMENTO", no_fault="NENHUMA",
    connection="CONEXAO", file_missing="ARQUIVO_AUSENTE", schema="SCHEMA", null_data="DADOS_NULOS",
    no_mechanism="NENHUM", retry="RETRY_BACKOFF", fallback="FALLBACK_ARQUIVO",
    schema_check="VALIDACAO_SCHEMA", quarantine="QUARENTENA",
    running="EM_ANDAMENTO", success="SUCESSO", error="ERRO",
)
ENGLISH_TERMS = Terms(
    control="CONTROL", treatment="TREATMENT", no_fault="NONE",
    connection="CONNECTION", file_missing="FILE_MISSING", schema="SCHEMA", null_data="NULL_DATA",
    no_mechanism="NONE", retry="RETRY_BACKOFF", fallback="FILE_FALLBACK",
    schema_check="SCHEMA_CHECK", quarantine="QUARANTINE",
    running="RUNNING", success="SUCCESS", error="ERROR",
)
