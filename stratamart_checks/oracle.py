"""The SQL each registered query must agree with, written for DuckDB over the given tables."""

from __future__ import annotations

_VIEWS = {
    "linhas": """
        SELECT l_orderkey * 10 + l_linenumber AS VendasID, l_suppkey AS VendedorID, l_partkey AS ProdutoID,
               CAST(l_quantity AS DECIMAL(12,2)) AS Quantidade, CAST(l_discount AS DECIMAL(4,2)) AS Desconto,
               CAST(l_shipdate AS DATE) AS DataVenda, l_orderkey || '-' || l_linenumber AS NumeroTransacao,
               l_orderkey
        FROM lineitem""",
    "vendas": """
        SELECT l.* EXCLUDE (l_orderkey), o_custkey AS ClienteID
        FROM linhas l LEFT JOIN orders ON l.l_orderkey = o_orderkey""",
    "vendas_1": "SELECT * FROM vendas WHERE DataVenda < DATE '1999-07-01'",
    "vendas_2": "SELECT * FROM vendas WHERE DataVenda >= DATE '1999-01-01' AND DataVenda < DATE '2000-01-01'",
    "vendas_3": "SELECT * FROM vendas WHERE DataVenda >= DATE '2000-01-01'",
    "marca": "SELECT max(DataVenda) AS ultima FROM vendas_1",
    "carregadas": """
        SELECT * FROM vendas_1
        UNION ALL SELECT v.* FROM vendas_2 v, marca WHERE DataVenda > ultima
        UNION ALL SELECT v.* FROM vendas_3 v, marca WHERE DataVenda > ultima""",
    "produtos": """
        SELECT p_partkey AS ProdutoID, p_name AS Produto, p_type AS CategoriaID,
               CAST(p_retailprice AS DECIMAL(12,2)) AS Preco,
               DATE '1995-01-01' + CAST(p_partkey % 1000 AS INTEGER) AS DataCadastro
        FROM part""",
    "precos": """
        SELECT ProdutoID, CAST(Preco + passo * 10 AS DECIMAL(12,2)) AS Preco, DataCadastro + passo * 400 AS DataCadastro
        FROM (SELECT *, CAST(unnest([0, 1, 2]) AS INTEGER) AS passo FROM produtos)""",
    "clientes": """
        SELECT c_custkey AS ClienteID, split_part(c_name, '#', 1) AS PrimeiroNome,
               CASE WHEN c_custkey % 3 <> 0 THEN c_mktsegment END AS NomeDoMeio,
               split_part(c_name, '#', -1) AS UltimoNome, c_nationkey AS CidadeID,
               CAST(c_acctbal AS DECIMAL(12,2)) AS Saldo
        FROM customer""",
    "vendedores": """
        SELECT s_suppkey AS VendedorID, split_part(s_name, '#', 1) AS PrimeiroNome,
               CAST(NULL AS VARCHAR) AS NomeDoMeio, split_part(s_name, '#', -1) AS UltimoNome, s_nationkey AS CidadeID
        FROM supplier""",
    "categorias": "SELECT DISTINCT p_type AS CategoriaID FROM part",
    "cidades": "SELECT n_nationkey AS CidadeID, n_name AS Cidade, n_regionkey AS PaisID FROM nation",
    "paises": "SELECT r_regionkey AS PaisID, r_name AS Pais FROM region",
    "clientes_nome": """
        SELECT ClienteID, concat_ws(' ', PrimeiroNome, NomeDoMeio, UltimoNome) AS Nome, CidadeID, Saldo
        FROM clientes""",
    "vendedores_nome": """
        SELECT VendedorID, concat_ws(' ', PrimeiroNome, NomeDoMeio, UltimoNome) AS Nome, CidadeID
        FROM vendedores""",
    "primeiros": """
        SELECT ClienteID FROM clientes
        WHERE ClienteID IN (SELECT o_custkey FROM orders WHERE o_orderdate < TIMESTAMP '1995-06-01')""",
    "dim_clientes": """
        SELECT c.*, row_number() OVER (ORDER BY ClienteID) AS SK_Cliente
        FROM clientes_nome c WHERE ClienteID IN (SELECT ClienteID FROM primeiros)""",
    "extrato": """
        SELECT ClienteID, Nome, Saldo,
               CASE WHEN Saldo >= 9000 THEN CidadeID + 1
                    WHEN Saldo >= 8000 AND Saldo < 8500 THEN NULL ELSE CidadeID END AS CidadeID
        FROM clientes_nome WHERE Saldo >= 0""",
    "pares": """
        SELECT d.ClienteID AS antes, d.SK_Cliente, e.*,
               d.Nome AS d_nome, d.CidadeID AS d_cidade, d.Saldo AS d_saldo,
               d.ClienteID IS NOT NULL AND e.ClienteID IS NOT NULL
                 AND (d.Nome, d.CidadeID, d.Saldo) IS DISTINCT FROM (e.Nome, e.CidadeID, e.Saldo) AS mudou
        FROM dim_clientes d FULL JOIN extrato e ON d.ClienteID = e.ClienteID""",
    "dim_historica": """
        SELECT antes AS ClienteID, d_nome AS Nome, d_cidade AS CidadeID, d_saldo AS Saldo, SK_Cliente,
               DATE '1996-01-01' AS data_inicio,
               CASE WHEN mudou THEN DATE '1998-06-01' ELSE DATE '9999-12-31' END AS data_fim,
               CASE WHEN mudou THEN 0 ELSE 1 END AS registro_ativo
        FROM pares WHERE antes IS NOT NULL
        UNION ALL
        SELECT ClienteID, Nome, CidadeID, Saldo,
               (SELECT max(SK_Cliente) FROM dim_clientes) + row_number() OVER (ORDER BY ClienteID),
               DATE '1998-06-01', DATE '9999-12-31', 1
        FROM pares WHERE antes IS NULL OR mudou""",
    "sk_clientes": "SELECT ClienteID, row_number() OVER (ORDER BY ClienteID) AS SK_Cliente FROM clientes",
    "sk_vendedores": "SELECT VendedorID, row_number() OVER (ORDER BY VendedorID) AS SK_Vendedor FROM vendedores",
    "sk_produtos": "SELECT ProdutoID, row_number() OVER (ORDER BY ProdutoID) AS SK_Produto FROM produtos",
}


def _with_views(select: str) -> str:
    return "WITH " + ",\n".join(f"{name} AS ({body})" for name, body in _VIEWS.items()) + "\n" + select


def _priced(source: str) -> str:
    return f"""
        SELECT v.*, round(p.Preco, 2) AS PrecoUnitario
        FROM {source} v LEFT JOIN produtos p ON v.ProdutoID = p.ProdutoID AND p.DataCadastro <= v.DataVenda"""


def _islands(columns: str, states: str) -> str:
    """History of dated states, one per key and day: runs of equal values, each until the next run."""
    key, *values = columns.split(", ")
    same = " AND ".join(f"{c} IS NOT DISTINCT FROM lag({c}) OVER w" for c in values)
    return f"""
        SELECT {columns}, CAST(dia AS VARCHAR) AS data_inicio,
               CAST(coalesce(lead(dia) OVER (PARTITION BY {key} ORDER BY dia), DATE '9999-12-31') AS VARCHAR) AS data_fim,
               CASE WHEN lead(dia) OVER (PARTITION BY {key} ORDER BY dia) IS NULL THEN 1 ELSE 0 END AS registro_ativo
        FROM (SELECT *, row_number() OVER w > 1 AND {same} AS igual FROM ({states}) WINDOW w AS (PARTITION BY {key} ORDER BY dia))
        WHERE NOT igual"""


_LINE_TOTAL = (
    "CAST(CAST(round(Quantidade * PrecoUnitario * (CAST(1 AS DECIMAL(4,2)) - Desconto), 2)"
    " AS DECIMAL(18,2)) AS DOUBLE) AS PrecoTotal"
)
_AMOUNTS = "CAST(Quantidade AS DOUBLE) AS Quantidade, CAST(Desconto AS DOUBLE) AS Desconto"
_UNIT_PRICE = "CAST(PrecoUnitario AS DOUBLE) AS PrecoUnitario"
_DAY = "CAST(DataVenda AS VARCHAR) AS DataVenda"
_MONTH = "CAST(year(DataVenda) AS INTEGER) AS Ano, CAST(month(DataVenda) AS INTEGER) AS Mes"
_LINE = f"VendasID, VendedorID, ProdutoID, {_AMOUNTS}, {_DAY}, NumeroTransacao"
_SALE = f"{_LINE}, ClienteID"
_FACT = f"VendasID, VendedorID, ClienteID, ProdutoID, {_AMOUNTS}, {_UNIT_PRICE}, {_LINE_TOTAL}, {_DAY}"
_CUSTOMER = "ClienteID, PrimeiroNome, NomeDoMeio, UltimoNome, CidadeID, CAST(Saldo AS DOUBLE) AS Saldo"
_HISTORY = "'1996-01-01' AS data_inicio, '9999-12-31' AS data_fim, 1 AS registro_ativo"


def _dimension(columns: str, source: str, key: str, sk: str) -> str:
    return f"SELECT {columns}, row_number() OVER (ORDER BY {key}) AS {sk}, {_HISTORY} FROM {source}"


def _gold(source: str) -> str:
    return f"""
        SELECT VendasID, {_AMOUNTS}, {_UNIT_PRICE}, {_LINE_TOTAL}, {_DAY}, {_MONTH}, SK_Cliente, SK_Vendedor, SK_Produto
        FROM ({_priced(source)}) f
        LEFT JOIN sk_clientes c ON f.ClienteID = c.ClienteID
        LEFT JOIN sk_vendedores s ON f.VendedorID = s.VendedorID
        LEFT JOIN sk_produtos p ON f.ProdutoID = p.ProdutoID"""


def _lines(table: str, source: str, columns: str) -> str:
    return f"SELECT '{table}' AS tabela, concat_ws('|', {columns}) AS linha FROM {source}"


def _nulls(table: str, source: str, column: str) -> str:
    return f"SELECT '{table}' AS tabela, 'nulo:{column}' AS regra, count(*) AS linhas FROM {source} WHERE {column} IS NULL"


def _duplicates(table: str, source: str, key: str) -> str:
    return (
        f"SELECT '{table}', 'duplicado:{key}', count(*) FROM"
        f" (SELECT {key} FROM {source} WHERE {key} IS NOT NULL GROUP BY {key} HAVING count(*) > 1)"
    )


def _orphans(source: str, key: str, parent: str) -> str:
    return (
        f"SELECT 'vendas', 'orfao:{key}', count(*) FROM {source} v"
        f" WHERE {key} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{key} = v.{key})"
    )


def _audit(batch: str) -> str:
    return f"""
        SELECT '{batch}' AS lote, count(*) AS lidas, count(*) FILTER (WHERE DataVenda > ultima) AS mantidas,
               count(*) FILTER (WHERE NOT coalesce(DataVenda > ultima, false)) AS descartadas,
               count(*) FILTER (WHERE DataVenda IS NULL) AS sem_data,
               CAST(min(DataVenda) AS VARCHAR) AS primeira_data, CAST(max(DataVenda) AS VARCHAR) AS ultima_data,
               CAST(max(ultima) AS VARCHAR) AS marca
        FROM {batch}, marca"""


_SELECTS = {
    "bronze_csv_scan": f"SELECT {_SALE} FROM vendas",
    "bronze_csv_batches": f"SELECT {_SALE} FROM vendas_2 UNION ALL SELECT {_SALE} FROM vendas_3",
    "table_scan": "SELECT * REPLACE (CAST(l_shipdate AS VARCHAR) AS l_shipdate) FROM lineitem",
    "partition_scan": f"SELECT {_SALE}, {_MONTH} FROM vendas WHERE year(DataVenda) = 1998 AND month(DataVenda) = 1",
    "overwrite_roundtrip": f"SELECT {_CUSTOMER} FROM clientes",
    "partitioned_overwrite": f"SELECT {_SALE}, {_MONTH} FROM vendas",
    "partitioned_append": f"""
        SELECT {_SALE}, {_MONTH} FROM vendas_1 UNION ALL SELECT {_SALE}, {_MONTH} FROM vendas_2
        UNION ALL SELECT {_SALE}, {_MONTH} FROM vendas_3""",
    "drop_columns": "SELECT ClienteID, CidadeID, CAST(Saldo AS DOUBLE) AS Saldo FROM clientes",
    "fact_column_order": f"SELECT {_FACT} FROM ({_priced('vendas')})",
    "reorder_after_key": "SELECT Cidade, CidadeID, PaisID FROM cidades",
    "filter_equality": """
        SELECT ProdutoID, CAST(DataCadastro AS VARCHAR) AS DataCadastro FROM produtos WHERE ProdutoID = 101""",
    "incremental_filter": f"""
        SELECT {_SALE} FROM (SELECT * FROM vendas_2 UNION ALL SELECT * FROM vendas_3), marca
        WHERE DataVenda > ultima""",
    "incremental_bootstrap": f"SELECT {_SALE} FROM vendas",
    "price_lookup_join": f"SELECT {_SALE}, {_UNIT_PRICE} FROM ({_priced('vendas')})",
    "fact_sk_lookup": f"""
        SELECT VendasID, {_AMOUNTS}, {_DAY}, SK_Cliente, SK_Vendedor, SK_Produto
        FROM vendas v
        LEFT JOIN sk_clientes c ON v.ClienteID = c.ClienteID
        LEFT JOIN sk_vendedores s ON v.VendedorID = s.VendedorID
        LEFT JOIN sk_produtos p ON v.ProdutoID = p.ProdutoID""",
    "high_watermark": "SELECT CAST(max(DataVenda) AS VARCHAR) AS DataVenda FROM vendas",
    "union_batches": f"SELECT {_SALE} FROM vendas_2 UNION ALL SELECT {_SALE} FROM vendas_3",
    "bronze_ingest": " UNION ALL ".join(
        _lines(table, source, columns)
        for table, source, columns in (
            ("categorias", "categorias", "CategoriaID"),
            ("produtos", "produtos", "ProdutoID, Produto, CategoriaID, Preco, DataCadastro"),
            ("clientes", "clientes", "ClienteID, PrimeiroNome, NomeDoMeio, UltimoNome, CidadeID, CAST(Saldo AS DOUBLE)"),
            ("cidades", "cidades", "CidadeID, Cidade, PaisID"),
            ("paises", "paises", "PaisID, Pais"),
            ("vendedores", "vendedores", "VendedorID, PrimeiroNome, NomeDoMeio, UltimoNome, CidadeID"),
            (
                "vendas",
                "vendas",
                "VendasID, VendedorID, ClienteID, ProdutoID, Quantidade, Desconto, DataVenda, NumeroTransacao",
            ),
        )
    ),
    "silver_customers": "SELECT ClienteID, Nome, CidadeID, CAST(Saldo AS DOUBLE) AS Saldo FROM clientes_nome",
    "silver_sellers": "SELECT * FROM vendedores_nome",
    "silver_passthrough": """
        SELECT 'produtos' AS tabela, concat_ws('|', ProdutoID, Produto, CategoriaID, Preco, DataCadastro) AS linha
        FROM produtos
        UNION ALL SELECT 'categorias', CategoriaID FROM categorias
        UNION ALL SELECT 'cidades', concat_ws('|', CidadeID, Cidade, PaisID) FROM cidades
        UNION ALL SELECT 'paises', concat_ws('|', PaisID, Pais) FROM paises""",
    "silver_sales_load": f"SELECT {_FACT}, {_MONTH} FROM ({_priced('vendas')})",
    "silver_sales": f"SELECT {_FACT}, {_MONTH} FROM ({_priced('vendas')})",
    "gold_dim_customer": _dimension(
        "ClienteID, Nome, CidadeID, CAST(Saldo AS DOUBLE) AS Saldo", "clientes_nome", "ClienteID", "SK_Cliente"
    ),
    "gold_dim_seller": _dimension("*", "vendedores_nome", "VendedorID", "SK_Vendedor"),
    "gold_dim_product": _dimension(
        "ProdutoID, Produto, CategoriaID, CAST(Preco AS DOUBLE) AS Preco,"
        " CAST(DataCadastro AS VARCHAR) AS DataCadastro",
        "produtos",
        "ProdutoID",
        "SK_Produto",
    ),
    "gold_dim_category": _dimension("*", "categorias", "CategoriaID", "SK_Categoria"),
    "gold_dim_city": _dimension("*", "cidades", "CidadeID", "SK_Cidade"),
    "gold_dim_country": _dimension("*", "paises", "PaisID", "SK_Pais"),
    "gold_sales": _gold("vendas"),
    "incremental_silver_sales": f"SELECT {_FACT}, {_MONTH} FROM ({_priced('carregadas')})",
    "surrogate_keys": """
        SELECT ClienteID, SK_Cliente FROM dim_clientes
        UNION ALL
        SELECT ClienteID, (SELECT max(SK_Cliente) FROM dim_clientes) + row_number() OVER (ORDER BY ClienteID)
        FROM clientes WHERE ClienteID NOT IN (SELECT ClienteID FROM primeiros)""",
    "scd2_merge": """
        SELECT ClienteID, Nome, CidadeID, CAST(Saldo AS DOUBLE) AS Saldo, SK_Cliente,
               CAST(data_inicio AS VARCHAR) AS data_inicio, CAST(data_fim AS VARCHAR) AS data_fim, registro_ativo
        FROM dim_historica""",
    "scd2_stored_apart": """
        SELECT ClienteID, Nome, CidadeID, CAST(Saldo AS DOUBLE) AS Saldo, SK_Cliente,
               CAST(data_inicio AS VARCHAR) AS data_inicio, CAST(data_fim AS VARCHAR) AS data_fim, registro_ativo
        FROM dim_historica""",
    "scd2_backdated": _islands(
        "ClienteID, Nome, CidadeID, Saldo",
        """
        SELECT ClienteID, Nome, CidadeID, Saldo, DATE '1996-01-01' AS dia FROM clientes_nome
        WHERE ClienteID IN (SELECT ClienteID FROM primeiros)
        UNION ALL
        SELECT ClienteID, Nome, CASE WHEN Saldo >= 8800 THEN CidadeID + 2 ELSE CidadeID END, Saldo, DATE '1997-03-01'
        FROM clientes_nome WHERE Saldo >= 2000
        UNION ALL SELECT ClienteID, Nome, CidadeID, Saldo, DATE '1998-06-01' FROM extrato""",
    ).replace("CidadeID, Saldo, CAST(dia", "CidadeID, CAST(Saldo AS DOUBLE) AS Saldo, CAST(dia"),
    "scd2_change_feed": _islands(
        "ClienteID, Prioridade",
        """
        SELECT ClienteID, 'NENHUMA' AS Prioridade, DATE '1996-01-01' AS dia FROM clientes
        WHERE ClienteID NOT IN (SELECT o_custkey FROM orders WHERE CAST(o_orderdate AS DATE) = DATE '1996-01-01')
        UNION ALL
        SELECT o_custkey, max_by(o_orderpriority, [epoch(o_orderdate), o_orderkey]), CAST(o_orderdate AS DATE)
        FROM orders GROUP BY o_custkey, CAST(o_orderdate AS DATE)""",
    ),
    "price_asof_join": f"""
        SELECT {_SALE}, CAST(p.Preco AS DOUBLE) AS PrecoUnitario
        FROM vendas v ASOF LEFT JOIN (SELECT ProdutoID AS produto, Preco, DataCadastro FROM precos) p
          ON v.ProdutoID = p.produto AND v.DataVenda >= p.DataCadastro""",
    "price_asof_time": """
        SELECT VendasID, VendedorID, ProdutoID, ClienteID, CAST(Quantidade AS DOUBLE) AS Quantidade,
               CAST(Desconto AS DOUBLE) AS Desconto, NumeroTransacao, CAST(DataHora AS VARCHAR) AS DataHora,
               CAST(p.Preco AS DOUBLE) AS PrecoUnitario
        FROM (SELECT *, CAST(DataVenda AS TIMESTAMP) + to_seconds(VendasID * 7919 % 86400) AS DataHora FROM vendas) v
        ASOF LEFT JOIN (
            SELECT ProdutoID AS produto, Preco + vez AS Preco,
                   CAST(DataCadastro AS TIMESTAMP) + to_seconds((ProdutoID * 613 + vez * 30011) % 86400) AS desde
            FROM (SELECT *, unnest([0, 1]) AS vez FROM precos)) p
          ON v.ProdutoID = p.produto AND v.DataHora >= p.desde""",
    "csv_merged_types": f"""
        SELECT VendasID, CAST(CAST(Quantidade AS INTEGER) AS DOUBLE) AS Quantidade,
               CAST(CAST(DataVenda AS TIMESTAMP) AS VARCHAR) AS DataVenda, CAST(ProdutoID AS VARCHAR) AS Codigo, {_MONTH} FROM vendas_1
        UNION ALL
        SELECT VendasID, CAST(Quantidade AS DOUBLE) + 0.25, CAST(CAST(DataVenda AS TIMESTAMP) AS VARCHAR),
               CAST(ProdutoID + 1099511627776 AS VARCHAR), {_MONTH} FROM vendas_2
        UNION ALL
        SELECT VendasID, CAST(CAST(Quantidade AS INTEGER) AS DOUBLE), CAST(CAST(DataVenda AS TIMESTAMP) AS VARCHAR),
               NumeroTransacao, {_MONTH} FROM vendas_3""",
    "layer_differences": """
        , guardadas AS (
            SELECT * REPLACE (CASE WHEN VendasID % 97 = 5 THEN Quantidade + 1 ELSE Quantidade END AS Quantidade,
                              CASE WHEN VendasID % 89 <> 7 THEN Desconto END AS Desconto)
            FROM vendas WHERE VendasID % 101 <> 3),
        camada AS (
            SELECT * FROM guardadas UNION ALL SELECT * FROM guardadas WHERE VendasID % 103 = 11
            UNION ALL SELECT * REPLACE (-VendasID AS VendasID) FROM guardadas WHERE VendasID % 107 = 13),
        a AS (SELECT VendasID, count(*) AS n, list(v ORDER BY v) AS linhas FROM vendas v GROUP BY VendasID),
        b AS (SELECT VendasID, count(*) AS n, list(c ORDER BY c) AS linhas FROM camada c GROUP BY VendasID)
        SELECT coalesce(a.VendasID, b.VendasID) AS VendasID,
               CASE WHEN b.n IS NULL THEN 'falta' WHEN a.n IS NULL THEN 'sobra' ELSE 'difere' END AS regra,
               coalesce(a.n, 0) AS esquerda, coalesce(b.n, 0) AS direita
        FROM a FULL JOIN b ON a.VendasID = b.VendasID WHERE a.linhas::VARCHAR IS DISTINCT FROM b.linhas::VARCHAR""",
    "history_check": """
        , com_erros AS (
            SELECT ClienteID, data_inicio, row_number() OVER () AS linha,
                   CASE WHEN ClienteID % 25 <> 3 THEN SK_Cliente ELSE 1 END AS sk,
                   CASE WHEN registro_ativo = 0 AND ClienteID % 4 = 0 THEN data_fim + 30
                        WHEN registro_ativo = 0 AND ClienteID % 4 = 1 THEN data_fim - 30
                        WHEN registro_ativo <> 0 AND ClienteID % 10 = 7 THEN data_inicio ELSE data_fim END AS data_fim,
                   CASE WHEN registro_ativo = 0 AND ClienteID % 4 = 2 THEN 1 ELSE registro_ativo END AS ativo
            FROM dim_historica),
        anteriores AS (
            SELECT d.linha, max(a.data_fim) FILTER (a.data_inicio < a.data_fim) AS fim, count(*) FILTER (a.ativo = 1) AS ativos
            FROM com_erros d JOIN com_erros a ON a.ClienteID = d.ClienteID AND a.data_inicio < d.data_inicio
            GROUP BY d.linha),
        contas AS (
            SELECT count(*) FILTER (data_inicio < data_fim AND data_inicio < a.fim) AS sobreposicao,
                   count(*) FILTER (data_inicio < data_fim AND data_inicio > a.fim) AS lacuna,
                   count(*) FILTER (ativo = 1 AND a.ativos > 0) AS dois_ativos,
                   count(*) FILTER (data_inicio >= data_fim) AS intervalo_vazio,
                   count(*) FILTER ((ativo = 1) <> (data_fim = DATE '9999-12-31')) AS fim_sem_sucessor,
                   count(*) FILTER (sk IN (SELECT sk FROM com_erros GROUP BY sk HAVING count(*) > 1)) AS sk_repetida,
                   count(*) FILTER (ClienteID IS NULL) AS sem_chave
            FROM com_erros d LEFT JOIN anteriores a USING (linha))
        SELECT 'clientes' AS tabela, regra, linhas FROM (UNPIVOT contas ON COLUMNS(*) INTO NAME regra VALUE linhas)""",
    "gold_inferred_members": """
        , usados AS (
            SELECT DISTINCT ClienteID FROM vendas
            WHERE ClienteID IS NOT NULL AND ClienteID NOT IN (SELECT ClienteID FROM primeiros)),
        todos AS (
            SELECT ClienteID, SK_Cliente FROM dim_clientes
            UNION ALL
            SELECT ClienteID, (SELECT max(SK_Cliente) FROM dim_clientes) + row_number() OVER (ORDER BY ClienteID) FROM usados)
        SELECT VendasID, SK_Cliente, v.ClienteID, Nome, '1996-01-01' AS data_inicio
        FROM vendas v LEFT JOIN todos USING (ClienteID) LEFT JOIN clientes_nome c ON v.ClienteID = c.ClienteID""",
    "fact_sk_point_in_time": f"""
        SELECT VendasID, {_AMOUNTS}, {_DAY}, SK_Cliente, SK_Vendedor, SK_Produto
        FROM vendas v
        LEFT JOIN (SELECT ClienteID, SK_Cliente, data_fim,
                          CASE WHEN row_number() OVER (PARTITION BY ClienteID ORDER BY data_inicio) > 1
                               THEN data_inicio ELSE DATE '0001-01-01' END AS desde
                   FROM dim_historica) c
          ON v.ClienteID = c.ClienteID AND desde <= DataVenda AND DataVenda < data_fim
        LEFT JOIN sk_vendedores s ON v.VendedorID = s.VendedorID
        LEFT JOIN sk_produtos p ON v.ProdutoID = p.ProdutoID""",
    "fact_sk_current": f"""
        SELECT VendasID, {_AMOUNTS}, {_DAY}, SK_Cliente, SK_Vendedor, SK_Produto
        FROM vendas v
        LEFT JOIN (SELECT ClienteID, SK_Cliente FROM dim_historica WHERE registro_ativo = 1) c
          ON v.ClienteID = c.ClienteID
        LEFT JOIN sk_vendedores s ON v.VendedorID = s.VendedorID
        LEFT JOIN sk_produtos p ON v.ProdutoID = p.ProdutoID""",
    "gold_incremental_refresh": _gold("carregadas"),
    "append_after_break": f"SELECT {_FACT}, {_MONTH} FROM ({_priced('carregadas')})",
    "refresh_months": f"""
        SELECT Ano, Mes, bool_or(novo) AS vendas_mudaram, bool_or(outro) AS versoes_mudaram
        FROM (
            SELECT {_MONTH}, DataVenda > ultima AS novo,
                   ClienteID IN (SELECT ClienteID FROM pares WHERE antes IS NULL)
                     OR (DataVenda >= DATE '1998-06-01' AND ClienteID IN (SELECT antes FROM pares WHERE mudou)) AS outro
            FROM carregadas, marca)
        GROUP BY Ano, Mes HAVING bool_or(novo) OR bool_or(outro)""",
    "dq_summary": " UNION ALL ".join(
        [
            *(_nulls("vendas", f"({_priced('vendas')})", c) for c in ("PrecoUnitario", "DataVenda")),
            _nulls("vendas", f"({_priced('vendas')})", "PrecoUnitario").replace("nulo:PrecoUnitario", "nulo:PrecoTotal"),
            _duplicates("vendas", "vendas", "VendasID"),
            _orphans("vendas", "ClienteID", "clientes"),
            _orphans("vendas", "VendedorID", "vendedores"),
            _orphans("vendas", "ProdutoID", "precos"),
            *(
                rule(table, source, key)
                for rule in (_nulls, _duplicates)
                for table, source, key in (
                    ("clientes", "clientes", "ClienteID"),
                    ("vendedores", "vendedores", "VendedorID"),
                    ("produtos", "precos", "ProdutoID"),
                    ("cidades", "cidades", "CidadeID"),
                    ("paises", "paises", "PaisID"),
                    ("categorias", "categorias", "CategoriaID"),
                )
            ),
        ]
    ),
    "load_audit": " UNION ALL ".join(_audit(b) for b in ("vendas_2", "vendas_3")),
    "sales_by_month": f"""
        SELECT {_MONTH}, count(*) AS vendas, CAST(sum(total) AS DOUBLE) AS total,
               count(*) FILTER (WHERE total IS NULL) AS sem_preco
        FROM (SELECT DataVenda, CAST(round(Quantidade * PrecoUnitario
                       * (CAST(1 AS DECIMAL(4,2)) - Desconto), 2) AS DECIMAL(18,2)) AS total
              FROM ({_priced('vendas')}))
        GROUP BY 1, 2""",
}

ORACLE_SQL = {name: _with_views(select) for name, select in _SELECTS.items()}
