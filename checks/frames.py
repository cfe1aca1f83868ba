"""Domain-shaped input frames derived from the driver tables, in Spark and in SQL.

Both sides use integer arithmetic and exact decimals only, so they agree to the cent.
Every frame covers all rows of its tables; the arithmetic on keys only varies the field
values (blanks, misspellings, shifted dates) so that each rule finds something to do.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimweave.plans import accounts as A
from claimweave.plans import cascade as C
from claimweave.plans import remittances as R
from claimweave.plans import staging as S
from claimweave.schemas import ASSOCIATION, HOSPITAL_ITEMS, REPORT_ROWS
from claimweave.session import shared_folder

RUN_TS = "2026-05-10 12:00:00"


def run_ts():
    return F.to_timestamp(F.lit(RUN_TS))


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _typed(df: DataFrame, schema) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


#: Columns of lineitem that the frames are made of.
_LINE_COLUMNS = (
    "l_orderkey l_linenumber l_partkey l_suppkey l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus l_shipdate"
).split()

_LINE_ID = (
    "md5(concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey, cast(round(l_extendedprice*100) as bigint),"
    " cast(l_quantity as bigint), cast(round(l_discount*100) as bigint), cast(round(l_tax*100) as bigint),"
    " l_returnflag, l_linestatus, date_format(l_shipdate,'yyyy-MM-dd')))"
)


class Frames:
    """Lazy frames of one scale-factor folder.

    ``written()`` gives frames whose sources with several readers are written once, below the shared folder, instead of
    being joined and shuffled again for every reader.
    """

    def __init__(self, spark: SparkSession, sf: str) -> None:
        self.spark, self.sf = spark, sf
        self._root: str | None = None
        self._tables: dict[str, DataFrame] = {}

    def written(self) -> Frames:
        frames = Frames(self.spark, self.sf)
        frames._root = f"{shared_folder(self.spark)}/frames-{uuid.uuid4().hex[:12]}"
        return frames

    def once(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """The frame itself, or its one written copy where these are :meth:`written` frames."""
        if self._root is None:
            return build()
        if name not in self._tables:
            frame = build()
            frame.write.option("compression", "zstd").parquet(f"{self._root}/{name}")
            self._tables[name] = self.spark.read.schema(frame.schema).parquet(f"{self._root}/{name}")
        return self._tables[name]

    def t(self, name: str) -> DataFrame:
        return table(self.spark, self.sf, name)

    def _order_lines(self, identified: bool = False) -> DataFrame:
        """lineitem with its order, and with the bytes of its content id where lines are wanted ``identified``."""
        orders = self.t("orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "o_orderstatus")
        # The join needs this distribution anyway when orders is large; when orders is small
        # it spreads a table that was stored as one row group over the cores.
        lineitem = self.t("lineitem")
        if identified:
            lineitem = lineitem.selectExpr("*", f"unhex({_LINE_ID}) as line_bytes")
        lineitem = lineitem.repartition("l_orderkey")
        return lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))

    def lines(self, identified: bool = False) -> DataFrame:
        """lineitem with its order, exact money, a content id and the process number.

        ``identified`` lines get their id before they are shuffled, which is shorter where few other columns are read.
        """
        if self._root is None:
            joined = self._order_lines(identified)
        else:
            names = [*_LINE_COLUMNS, "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "o_orderstatus"]
            joined = self.once("lines", lambda: self._order_lines().select(*names))
        return joined.selectExpr(
            "*",
            "cast(l_extendedprice as decimal(18,2)) as price",
            "cast(l_discount as decimal(18,2)) as disc",
            "lower(hex(line_bytes)) as line_id" if "line_bytes" in joined.columns else f"{_LINE_ID} as line_id",
            "cast(l_shipdate as date) as ship",
            "cast(o_orderdate as date) as ordered",
            "concat('P', 100000 + l_orderkey, '/', year(o_orderdate) + 27) as processo",
            "l_suppkey % 20 as remessa",
            "case when l_partkey % 11 = 0 then '' else concat('S', l_partkey % 40) end as pf",
            "case when l_partkey % 3 = 0 then '' else concat('s', l_partkey % 60) end as tuss",
            "case when l_partkey % 97 = 0 then '' else concat('0', o_custkey % 100) end as cartao",
        )

    def items(self) -> DataFrame:
        """Hospital billing lines."""
        df = self.lines().selectExpr(
            "remessa as cd_remessa",
            "l_orderkey as cd_reg",
            "l_linenumber as cd_lancamento",
            "l_partkey as cd_atendimento",
            "o_custkey as cd_paciente",
            "concat('PACIENTE ', o_custkey) as nm_paciente",
            "l_suppkey as cd_prestador",
            "concat('PRESTADOR ', l_suppkey) as nm_prestador",
            "10 as cd_convenio",
            "'07204600000170' as cnpj_convenio",
            "'IPM' as nm_convenio",
            "o_orderpriority as tp_atendimento",
            "concat('g', l_orderkey % 500) as nr_guia",
            "cartao as nr_carteira",
            "pf as cd_pro_fat",
            "tuss as cd_tuss",
            "concat('ITEM ', l_partkey) as descricao",
            "o_orderdate as dt_atendimento",
            "cast(null as timestamp_ntz) as dt_alta",
            "trunc(ship, 'month') as dt_competencia",
            "cast(case when l_partkey % 4 = 0 then date_add(ship, 40) else ship end as timestamp_ntz) as dt_lancamento",
            "cast(l_quantity as decimal(18,4)) as qt_lancamento",
            "price as vl_total_conta",
            "l_partkey % 7 as cd_gru_fat",
            "concat('GRUPO ', l_partkey % 7) as ds_gru_fat",
            "l_partkey % 5 as cd_gru_pro",
            "concat('PRO ', l_partkey % 5) as ds_gru_pro",
        )
        return _typed(df, HOSPITAL_ITEMS)

    def month_totals(self) -> DataFrame:
        months = F.trunc("ship", "month").alias("mes")
        return self.once("month_totals", lambda: self.lines().groupBy("remessa", months).agg(F.sum("price").cast("decimal(18,2)").alias("total")))

    def totals(self) -> DataFrame:
        """Remittance totals: some months are missing, some have a twin of equal value."""
        base = self.month_totals().withColumn("n", F.expr("remessa + year(mes)*12 + month(mes)")).filter("n % 23 <> 0")
        twins = base.filter("n % 29 = 0").withColumn("remessa", F.col("remessa") + 1000)
        return base.unionByName(twins).selectExpr(
            "remessa as cd_remessa",
            "'IPM' as nm_convenio",
            "'07204600000170' as cnpj_convenio",
            "date_format(mes,'MM/yyyy') as competencia",
            "total as valor_total",
        )

    def association(self) -> DataFrame:
        """Monthly statement lines with their process association."""
        totals = self.month_totals().select(F.col("remessa").alias("r2"), F.col("mes").alias("m2"), "total")
        lines = self.lines().withColumn("v", F.expr("(l_orderkey + l_partkey) % 8"))
        joined = lines.join(totals, (F.col("remessa") == F.col("r2")) & (F.trunc("ship", "month") == F.col("m2")))
        code = "case when v in (2,6,7) then tuss else pf end"
        df = joined.selectExpr(
            "line_id as id_registro",
            "trunc(ship,'month') as referencia",
            "concat('L', l_suppkey) as numero_lote",
            "concat(' nr', remessa) as numero_protocolo",
            "price as valor_protocolo",
            "cast(price * disc as decimal(18,2)) as valor_glosa_protocolo",
            "case when v in (1,5,7) then '' when v = 2 then 'zz' else concat(' G', l_orderkey % 500, ' ') end as numero_guia_senha",
            "case when v = 3 then ordered when v in (2,6) and l_partkey % 4 = 0 then date_add(ship, 40)"
            " when v = 6 then ordered else ship end as data_realizacao",
            f"concat('SERVICO ', {code}) as descricao_servico",
            "'22' as codigo_tabela",
            f"{code} as codigo_servico",
            "cast(l_quantity as decimal(18,4)) as quantidade_executada",
            "price + case when v = 5 then 1 else 0 end as valor_processado",
            "price - cast(price * disc as decimal(18,2)) as valor_liberado",
            "cast(price * disc as decimal(18,2)) as valor_glosa",
            "case when l_linenumber = 7 then ' ' else concat(' ', l_linenumber * 100) end as codigo_glosa",
            "concat('PACIENTE ', o_custkey) as nome_beneficiario",
            "case when v = 4 then 'x' else cartao end as codigo_beneficiario",
            "concat('c', l_orderkey) as cogestao_id_registro",
            "processo as numero_processo",
            "date_format(ship,'MM/yyyy') as competencia_producao",
            "total as valor_protocolo_cogestao",
            "case when l_orderkey % 17 = 0 then 'SEM_PROCESSO' when l_orderkey % 19 = 0 then 'AMBIGUO' else 'ASSOCIADO_AUTO' end"
            " as status_associacao",
            "'[]' as candidatos_associacao",
        )
        return _typed(df, ASSOCIATION)

    def manual(self) -> DataFrame:
        """Manual remittance overrides, some pointing to a remittance that does not exist."""
        return self.lines().filter("l_returnflag = 'R' and l_orderkey % 13 = 0").selectExpr(
            "lower(processo) as numero_processo",
            "concat(' ', date_format(ship,'MM/yyyy'), ' ') as competencia_producao",
            "concat('NR', remessa, ' ') as nr",
            "case when l_orderkey % 26 = 0 then 9999 else remessa end as cd_remessa",
        ).distinct()

    def reports(self) -> DataFrame:
        """One account report row per order, from the first line of the order."""
        first = self.lines().groupBy("l_orderkey", "o_custkey", "o_orderstatus", "o_orderdate").agg(
            F.min(F.struct("l_linenumber", "l_partkey", "l_suppkey", "price", "ship")).alias("l")
        )
        df = first.selectExpr(
            "md5(concat('rel|', l_orderkey)) as id_registro",
            "concat(case when l_orderkey % 7 = 0 then ' p' else 'P' end, 100000 + o_custkey, '/', 2022 + o_custkey % 8) as numero_processo",
            "case when o_orderstatus = 'F' then ' finalizado' when o_orderstatus = 'O' then 'TRAMITANDO '"
            " when l_orderkey % 2 = 0 then 'FINALIZADO' else 'Rascunho' end as status_processo",
            "concat('D', l_orderkey) as documento_id",
            "concat('relatorio_', l.l_suppkey % 20, '_', l_orderkey, '.pdf') as documento_nome",
            "1 + l_orderkey % 3 as pagina_pdf",
            "l.l_suppkey % 20 as cd_remessa",
            "concat('PACIENTE ', o_custkey) as nome_paciente",
            "case when l_orderkey % 4 = 0 then '' else concat(' G', l_orderkey % 500) end as numero_guia",
            "case when l_orderkey % 5 = 0 then null when l_orderkey % 5 = 1 then concat('9999999999999999999', l_orderkey)"
            " else concat('c ', l_orderkey) end as numero_conta",
            "case when l_orderkey % 3 = 0 then null else l.l_partkey end as cd_atendimento",
            "trunc(l.ship, 'month') as competencia",
            "l.price as valor",
            "cast(o_orderdate as timestamp) as extraido_em",
        )
        return self.once("reports", lambda: _typed(df, REPORT_ROWS))

    # staged models used by many queries
    def denials(self) -> DataFrame:
        return S.stage_denials(self.association())

    def staged_items(self) -> DataFrame:
        return S.stage_items(self.items())

    def staged_reports(self) -> DataFrame:
        return self.once("staged_reports", lambda: S.stage_reports(self.reports()))

    def cascade_denials(self) -> DataFrame:
        """Denials with the columns that remittances and rules read."""
        return self.once("denials", lambda: self.denials().select(*C.DENIAL_COLUMNS))

    def remittances(self) -> DataFrame:
        return R.match_remittances(self.cascade_denials(), self.totals(), self.manual())

    def accounts(self) -> DataFrame:
        return A.resolve_accounts(self.staged_reports(), self.staged_items())

    def report_items(self) -> DataFrame:
        return A.report_items(self.accounts(), self.staged_reports(), self.staged_items())

    def inputs(self) -> dict[str, DataFrame]:
        return {
            "association": self.association(),
            "items": self.items(),
            "reports": self.reports(),
            "totals": self.totals(),
            "manual": self.manual(),
        }


# --- the same frames as SQL ----------------------------------------------

_DIGEST_COLUMNS = (
    "cd_remessa conta cd_lancamento cd_atendimento cd_paciente nm_paciente cd_prestador nm_prestador cd_convenio "
    "cnpj_convenio nm_convenio tp_atendimento guia carteira_zero carteira pf tuss descricao dt_atendimento dt_alta "
    "dt_competencia dt_lancamento qt_lancamento valor_item cd_gru_fat ds_gru_fat cd_gru_pro ds_gru_pro"
).split()
_DIGEST = "md5(concat_ws(chr(31), " + ", ".join(f"coalesce(cast({c} as varchar), chr(0))" for c in _DIGEST_COLUMNS) + "))"

RULES_SQL = """(values
  (11,'relatorio_hpc_competencia_guia_servico_carteira','c',true,'pf',false,false),
  (12,'relatorio_hpc_competencia_servico_carteira','c',false,'pf',false,false),
  (13,'relatorio_hpc_competencia_tuss_carteira_valor','c',false,'tuss',true,true),
  (14,'relatorio_hpc_lancamento_servico_carteira','l',false,'pt',false,false),
  (15,'relatorio_hpc_competencia_servico_valor','c',false,'tp',false,true),
  (16,'relatorio_hpc_atendimento_guia_servico_valor','a',true,'tp',false,true),
  (17,'relatorio_hpc_lancamento_servico_carteira_valor','l',false,'pf',false,true),
  (21,'cogestao_competencia_guia_servico_carteira','c',true,'pf',false,false),
  (22,'cogestao_competencia_servico_carteira','c',false,'pf',false,false),
  (23,'cogestao_competencia_tuss_carteira','c',false,'tuss',true,true),
  (24,'cogestao_lancamento_coalesce_servico_carteira','l',false,'pt',false,false),
  (25,'cogestao_competencia_coalesce_servico_valor','c',false,'tp',false,true),
  (26,'cogestao_atendimento_guia_coalesce_servico_valor','a',true,'tp',false,true),
  (27,'cogestao_lancamento_pro_fat_carteira_valor','l',false,'pf',false,true))
  t(prio, crit, mes, usa_guia, serv, cheio, usa_valor)"""

_FITS = """(d.mes = case r.mes when 'c' then i.mes_c when 'l' then i.mes_l else i.mes_a end)
  and (not r.usa_guia or i.guia = d.guia) and (not r.cheio or i.tuss <> '') and (not r.usa_valor or i.valor_item = d.valor)
  and d.servico = case r.serv when 'pf' then i.pf when 'tuss' then i.tuss
      when 'pt' then coalesce(nullif(i.pf,''), i.tuss) else coalesce(nullif(i.tuss,''), i.pf) end"""

CTE = {
    "lines": """select l.*, o.o_custkey, o.o_orderdate, o.o_orderpriority, o.o_orderstatus,
  cast(l_extendedprice as decimal(18,2)) price, cast(l_discount as decimal(18,2)) disc,
  md5(concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey, cast(round(l_extendedprice*100) as bigint),
    cast(l_quantity as bigint), cast(round(l_discount*100) as bigint), cast(round(l_tax*100) as bigint),
    l_returnflag, l_linestatus, strftime(l_shipdate,'%Y-%m-%d'))) line_id,
  cast(l_shipdate as date) ship, cast(o_orderdate as date) ordered,
  'P' || (100000 + l_orderkey) || '/' || (year(o_orderdate) + 27) processo, l_suppkey % 20 remessa,
  case when l_partkey % 11 = 0 then '' else 'S' || (l_partkey % 40) end pf0,
  case when l_partkey % 3 = 0 then '' else 's' || (l_partkey % 60) end tuss0,
  case when l_partkey % 97 = 0 then '' else '0' || (o_custkey % 100) end cartao
  from lineitem l join orders o on l_orderkey = o_orderkey""",
    "items": f"""select *, {_DIGEST} digest, strftime(dt_competencia,'%Y-%m') mes_c, strftime(dt_lancamento,'%Y-%m') mes_l,
  strftime(dt_atendimento,'%Y-%m') mes_a from (
  select cast(remessa as bigint) cd_remessa, l_orderkey conta, cast(l_linenumber as bigint) cd_lancamento, l_partkey cd_atendimento,
   o_custkey cd_paciente, 'PACIENTE ' || o_custkey nm_paciente, l_suppkey cd_prestador, 'PRESTADOR ' || l_suppkey nm_prestador,
   cast(10 as bigint) cd_convenio, '07204600000170' cnpj_convenio, 'IPM' nm_convenio, o_orderpriority tp_atendimento,
   upper('g' || (l_orderkey % 500)) guia, cartao carteira_zero, ltrim(cartao,'0') carteira, upper(pf0) pf, upper(tuss0) tuss,
   'ITEM ' || l_partkey descricao, o_orderdate dt_atendimento, cast(null as timestamp) dt_alta,
   cast(date_trunc('month', ship) as date) dt_competencia,
   cast(case when l_partkey % 4 = 0 then ship + 40 else ship end as timestamp) dt_lancamento,
   cast(l_quantity as decimal(18,4)) qt_lancamento, price valor_item, cast(l_partkey % 7 as bigint) cd_gru_fat,
   'GRUPO ' || (l_partkey % 7) ds_gru_fat, cast(l_partkey % 5 as bigint) cd_gru_pro, 'PRO ' || (l_partkey % 5) ds_gru_pro
  from lines)""",
    "month_totals": """select remessa, cast(date_trunc('month', ship) as date) mes, cast(sum(price) as decimal(18,2)) total
  from lines group by 1, 2""",
    "totals": """select remessa + k.add_id cd_remessa, strftime(mes,'%m/%Y') competencia, total valor_total,
  'IPM' nm_convenio, '07204600000170' cnpj_convenio
  from month_totals cross join (values (0), (1000)) k(add_id)
  where (remessa + year(mes)*12 + month(mes)) % 23 <> 0
    and (k.add_id = 0 or (remessa + year(mes)*12 + month(mes)) % 29 = 0)""",
    "denials": """select line_id id_registro, cast(date_trunc('month', ship) as date) referencia, 'L' || l_suppkey numero_lote,
   ' nr' || remessa numero_protocolo, price valor_protocolo, glosa valor_glosa_protocolo,
   case when v in (1,5,7) then '' when v = 2 then 'zz' else ' G' || (l_orderkey % 500) || ' ' end numero_guia_senha,
   case when v = 3 then ordered when v in (2,6) and l_partkey % 4 = 0 then ship + 40 when v = 6 then ordered else ship end data_realizacao,
   case when v in (2,6,7) then tuss0 else pf0 end codigo_servico, cast(l_quantity as decimal(18,4)) quantidade_executada,
   cast(price + case when v = 5 then 1 else 0 end as decimal(18,2)) valor_processado, cast(price - glosa as decimal(18,2)) valor_liberado,
   glosa valor_glosa, case when l_linenumber = 7 then ' ' else ' ' || (l_linenumber * 100) end codigo_glosa,
   case when v = 4 then 'x' else cartao end codigo_beneficiario, processo numero_processo,
   strftime(ship,'%m/%Y') competencia_producao, total valor_protocolo_cogestao,
   case when l_orderkey % 17 = 0 then 'SEM_PROCESSO' when l_orderkey % 19 = 0 then 'AMBIGUO' else 'ASSOCIADO_AUTO' end status_associacao
  from (select l.*, (l_orderkey + l_partkey) % 8 v, cast(price * disc as decimal(18,2)) glosa, t.total
        from lines l join month_totals t on t.remessa = l.remessa and t.mes = cast(date_trunc('month', l.ship) as date))
  where glosa > 0""",
    "manual": """select distinct processo numero_processo, strftime(ship,'%m/%Y') competencia_producao, 'NR' || remessa nr,
   case when l_orderkey % 26 = 0 then 9999 else remessa end cd_remessa
  from lines where l_returnflag = 'R' and l_orderkey % 13 = 0""",
    "raw_reports": """select md5('rel|' || l_orderkey) id_registro,
   (case when l_orderkey % 7 = 0 then ' p' else 'P' end) || (100000 + o_custkey) || '/' || (2022 + o_custkey % 8) numero_processo,
   case when o_orderstatus = 'F' then ' finalizado' when o_orderstatus = 'O' then 'TRAMITANDO '
        when l_orderkey % 2 = 0 then 'FINALIZADO' else 'Rascunho' end status_processo,
   'D' || l_orderkey documento_id, 'relatorio_' || (l_suppkey % 20) || '_' || l_orderkey || '.pdf' documento_nome,
   1 + l_orderkey % 3 pagina_pdf, l_suppkey % 20 cd_remessa, 'PACIENTE ' || o_custkey nome_paciente,
   case when l_orderkey % 4 = 0 then '' else ' G' || (l_orderkey % 500) end numero_guia,
   case when l_orderkey % 5 = 0 then null when l_orderkey % 5 = 1 then '9999999999999999999' || l_orderkey
        else 'c ' || l_orderkey end numero_conta,
   case when l_orderkey % 3 = 0 then null else l_partkey end cd_atendimento,
   cast(date_trunc('month', ship) as date) competencia, price valor, o_orderdate extraido_em, l_orderkey, o_custkey
  from (select *, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, price, ship) n from lines)
  where n = 1""",
    "reports": """select r.id_registro, trim(r.numero_processo) numero_processo, upper(trim(r.numero_processo)) processo,
   upper(trim(status_processo)) status_processo, documento_id, documento_nome, pagina_pdf, cd_remessa, nome_paciente,
   upper(trim(numero_guia)) guia, case when numero_conta like 'c %' then cast(substr(numero_conta, 3) as bigint) end conta_informada,
   cd_atendimento, m.mes competencia, valor, extraido_em
  from raw_reports r join (
    select p, mes from (select upper(trim(numero_processo)) p, competencia mes, count(*) n from raw_reports group by 1, 2)
    qualify row_number() over (partition by p order by n desc, mes desc) = 1) m on m.p = upper(trim(r.numero_processo))
  where upper(trim(status_processo)) in ('FINALIZADO','TRAMITANDO') and cast(right(r.numero_processo, 4) as int) >= 2024""",
    "accounts": """select distinct id_registro, numero_processo, processo, status_processo, cd_remessa, competencia, guia, conta, crit from (
   select *, min(prio) filter (where nc = 1) over (partition by id_registro) best from (
    select *, count(distinct conta) over (partition by id_registro, prio) nc from (
     select r.id_registro, r.numero_processo, r.processo, r.status_processo, r.cd_remessa, r.competencia, r.guia, i.conta, k.prio, k.crit
     from reports r join (select distinct cd_remessa, conta, cd_atendimento, guia from items) i on i.cd_remessa = r.cd_remessa
     join (values (1,'remessa_conta_atendimento',true,true,false),(2,'remessa_conta_guia',true,false,true),
      (3,'remessa_atendimento_guia',false,true,true),(4,'remessa_conta',true,false,false)) k(prio,crit,uc,ua,ug)
      on (not uc or i.conta = r.conta_informada) and (not ua or i.cd_atendimento = r.cd_atendimento)
      and (not ug or (r.guia <> '' and i.guia = r.guia))
      where i.conta = r.conta_informada or (i.cd_atendimento = r.cd_atendimento and i.guia = r.guia)))) where prio = best""",
    "report_items": """select md5(a.id_registro || '|' || i.digest) id_item_relatorio, a.id_registro id_registro_relatorio, a.numero_processo,
   a.processo, a.status_processo, r.documento_id, r.documento_nome, r.pagina_pdf, a.competencia, r.nome_paciente, r.valor valor_conta,
   a.crit criterio_conta, i.*
  from (select a.*, row_number() over (partition by a.processo, a.cd_remessa, a.conta
          order by r.extraido_em desc, a.id_registro desc) n
        from accounts a join reports r using (id_registro)) a
  join reports r using (id_registro)
  join (select distinct * from items) i on i.cd_remessa = a.cd_remessa and i.conta = a.conta
  where a.n = 1""",
    "remittances": """select numero_processo, competencia_producao, protocolo numero_protocolo, vp valor_protocolo, cd_remessa, vt valor_total_remessa, origem from (
    with p as (select distinct numero_processo, competencia_producao, upper(trim(numero_protocolo)) protocolo, valor_protocolo_cogestao vp
               from denials where status_associacao like 'ASSOCIADO%')
    select p.*, t.cd_remessa, t.valor_total vt, 'automatica' origem, count(*) over (partition by p.numero_processo, p.competencia_producao, p.protocolo, p.vp) n
    from p join totals t on t.competencia = p.competencia_producao and t.valor_total = p.vp
    where not exists (select 1 from manual m where m.numero_processo = p.numero_processo
       and m.competencia_producao = p.competencia_producao and m.nr = p.protocolo)
    union all
    select p.*, t.cd_remessa, t.valor_total, 'manual', 1 from manual m
    join p on p.numero_processo = m.numero_processo and p.competencia_producao = m.competencia_producao and p.protocolo = m.nr
    join totals t on t.cd_remessa = m.cd_remessa and t.competencia = m.competencia_producao) where n = 1""",
    "asked": """select d.*, upper(trim(numero_guia_senha)) guia, upper(trim(codigo_servico)) servico,
   ltrim(regexp_replace(codigo_beneficiario, '[^0-9]', '', 'g'), '0') carteira, strftime(data_realizacao,'%Y-%m') mes,
   valor_processado valor from denials d""",
    "direct_raw": """select distinct d.id_registro, i.numero_processo proc, i.cd_remessa, i.conta, i.cd_lancamento, i.digest
  from asked d join report_items i on i.guia = d.guia and i.guia <> '' and d.carteira <> '' and i.carteira = d.carteira
   and d.servico in (i.pf, i.tuss)""",
    "direct": """select * from direct_raw where id_registro in (select id_registro from direct_raw group by 1
   having count(distinct (proc, cd_remessa, conta)) = 1)""",
    "rules": f"select * from {RULES_SQL}",
    "fallback_raw": f"""select r.prio, r.crit, d.id_registro, i.numero_processo proc, i.cd_remessa, i.conta, i.cd_lancamento, i.digest
  from (select * from asked where id_registro not in (select id_registro from direct)) d
  join report_items i on i.carteira = d.carteira and d.servico in (i.pf, i.tuss)
  join rules r on r.prio < 20 and {_FITS}""",
    "fallback": """select f.* from fallback_raw f join (
    select id_registro, min(prio) prio from (select id_registro, prio from fallback_raw group by 1, 2
      having count(distinct (proc, cd_remessa, conta)) = 1) group by 1) s using (id_registro, prio)""",
    "legacy": f"""select r.prio, r.crit, d.id_registro, d.numero_processo proc, i.cd_remessa, i.conta, i.cd_lancamento, i.digest
  from (select a.*, m.cd_remessa esperada from asked a join remittances m on m.numero_processo = a.numero_processo
        and m.competencia_producao = a.competencia_producao and m.valor_protocolo = a.valor_protocolo_cogestao
        and m.numero_protocolo = upper(trim(a.numero_protocolo)) where a.status_associacao like 'ASSOCIADO%') d
  join items i on i.cd_remessa = d.esperada and i.carteira = d.carteira and d.servico in (i.pf, i.tuss)
  join rules r on r.prio > 20 and {_FITS}""",
    "candidates": """select 1 prio, 'relatorio_hpc_guia_beneficiario_servico' crit, id_registro, proc, cd_remessa, conta, cd_lancamento, digest from direct
  union all select prio, crit, id_registro, proc, cd_remessa, conta, cd_lancamento, digest from fallback
  union all select prio, crit, id_registro, proc, cd_remessa, conta, cd_lancamento, digest from legacy""",
    "counted": """select id_registro, prio, crit, count(distinct (proc, cd_remessa, conta)) nc,
   count(distinct (proc, cd_remessa, conta, cd_lancamento)) ni from candidates group by 1, 2, 3""",
    "resolved": """select c.id_registro, c.proc numero_processo, c.crit criterio,
   case when s.ni = 1 then 'item_unico' else 'conta_unica' end status_correspondencia, i.*
  from candidates c join (select * from counted where nc = 1
    qualify row_number() over (partition by id_registro order by prio) = 1) s on s.id_registro = c.id_registro and s.prio = c.prio
  join (select distinct * from items) i on i.digest = c.digest
  qualify row_number() over (partition by c.id_registro order by c.proc, c.cd_remessa, c.conta, c.cd_lancamento, c.digest) = 1""",
    "linked": """select r.*, d.competencia_producao, d.numero_protocolo, d.numero_lote, d.referencia, d.valor_protocolo, d.valor_glosa_protocolo,
   d.data_realizacao, d.codigo_servico, d.codigo_glosa, d.codigo_beneficiario, d.valor_processado, d.valor_liberado, d.valor_glosa,
   'SERVICO ' || d.codigo_servico descricao_servico
  from resolved r join denials d using (id_registro)""",
}

_NEEDS = {
    "lines": (),
    "items": ("lines",),
    "month_totals": ("lines",),
    "totals": ("month_totals",),
    "denials": ("lines", "month_totals"),
    "manual": ("lines",),
    "raw_reports": ("lines",),
    "reports": ("raw_reports",),
    "accounts": ("reports", "items"),
    "report_items": ("accounts", "reports", "items"),
    "remittances": ("denials", "totals", "manual"),
    "asked": ("denials",),
    "direct_raw": ("asked", "report_items"),
    "direct": ("direct_raw",),
    "rules": (),
    "fallback_raw": ("asked", "direct", "report_items", "rules"),
    "fallback": ("fallback_raw",),
    "legacy": ("asked", "remittances", "items", "rules"),
    "candidates": ("direct", "fallback", "legacy"),
    "counted": ("candidates",),
    "resolved": ("candidates", "counted", "items"),
    "linked": ("resolved", "denials"),
}


def sql(select: str, *needs: str) -> str:
    """``WITH`` clause of the named frames and everything below them, then the select."""
    order: list[str] = []

    def add(name: str) -> None:
        for other in _NEEDS[name]:
            add(other)
        if name not in order:
            order.append(name)

    for name in needs:
        add(name)
    heads = ", ".join(f"{name} as materialized ({CTE[name]})" for name in order)
    return f"with {heads} {select}" if heads else select
