"""The ten source relations the pipeline reads (invoices, people, addresses)."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class SourceTables:
    nota_fiscal: DataFrame        # id, data_venda, id_cliente, id_vendedor
    item_nota_fiscal: DataFrame   # id_nota_fiscal, id_produto, quantidade, valor_unitario, valor_venda_real
    produto: DataFrame            # id, nome, valor_venda, id_categoria
    categoria: DataFrame          # id, descricao
    pessoa_fisica: DataFrame      # id, nome, cpf
    pessoa_juridica: DataFrame    # id, razao_social, cnpj
    endereco: DataFrame           # id, id_pessoa, rua, numero, complemento, cep, id_bairro
    bairro: DataFrame             # id, descricao, id_cidade
    cidade: DataFrame             # id, descricao, id_estado
    estado: DataFrame             # id, descricao, sigla

    def names(self) -> list[str]:
        return [f.name for f in fields(self)]

    def register(self, spark: SparkSession | None = None) -> "SourceTables":
        """Expose every relation as a temp view of the same name (for SQL users)."""
        for name in self.names():
            getattr(self, name).createOrReplaceTempView(name)
        return self
