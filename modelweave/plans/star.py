"""The declared model of the shared test tables: keys, references, checks and value rules."""

from __future__ import annotations

from modelweave.model import Check, Column, ForeignKey, Key, Model, Table


def _table(name: str, key: tuple[str, ...], *columns: Column, checks: tuple[Check, ...] = ()) -> Table:
    return Table(name, columns, (Key("pk", key, primary=True),), checks)


STAR = Model(
    tables=(
        _table("region", ("r_regionkey",), Column("r_name", "string", nullable=False)),
        _table("nation", ("n_nationkey",), Column("n_name", "string", nullable=False)),
        _table(
            "customer",
            ("c_custkey",),
            Column("c_acctbal", "double", rules={"minimum": 0}),
            checks=(Check("segment_set", "c_mktsegment <> ''"),),
        ),
        _table("supplier", ("s_suppkey",), Column("s_name", "string", nullable=False)),
        _table("part", ("p_partkey",), Column("p_size", "int", rules={"minimum": 1, "maximum": 40})),
        _table(
            "orders",
            ("o_orderkey",),
            Column("o_orderstatus", "string", nullable=False, rules={"enum": ["F", "O"]}),
            checks=(Check("large", "o_totalprice >= 100000"), Check("later", "o_orderdate > '1990-01-01'", validate=False)),
        ),
        _table("lineitem", ("l_orderkey", "l_linenumber"), Column("l_discount", "double", rules={"maximum": 0.05})),
    ),
    foreign_keys=(
        ForeignKey("fk_region", "nation", ("n_regionkey",), "region", ("r_regionkey",), "CASCADE"),
        ForeignKey("fk_nation", "customer", ("c_nationkey",), "nation", ("n_nationkey",), "CASCADE"),
        ForeignKey("fk_nation", "supplier", ("s_nationkey",), "nation", ("n_nationkey",), "CASCADE"),
        ForeignKey("fk_customer", "orders", ("o_custkey",), "customer", ("c_custkey",), "CASCADE"),
        ForeignKey("fk_order", "lineitem", ("l_orderkey",), "orders", ("o_orderkey",), "CASCADE", cardinality=(1, 7)),
        ForeignKey("fk_part", "lineitem", ("l_partkey",), "part", ("p_partkey",)),
        ForeignKey("fk_supplier", "lineitem", ("l_suppkey",), "supplier", ("s_suppkey",), "CASCADE"),
    ),
)
