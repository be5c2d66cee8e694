"""Column masking policies bound to a table.

A policy is a typed ``Column -> Column`` function of the current role.
``apply_masks`` is the first projection above the scan, so every later
filter, join and aggregate sees masked values. The role is known when
the plan is built, so the CASE folds to the column or to a literal.

``Catalog.set_masks`` binds policies to a table's columns; ``Catalog.read``
resolves them for the session's role, so a reader cannot forget them.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class MaskPolicy:
    name: str
    mask_value: object
    type_name: str
    allowed_roles: tuple[str, ...] = ("ACCOUNTADMIN",)

    def apply(self, c: Column, role) -> Column:
        """``role`` is a name (folds to the column or to the mask) or a Column."""
        r = F.upper(role) if isinstance(role, Column) else F.lit(role.upper())
        # the ELSE branch ignores the value, so NULL is masked too
        return (F.when(r.isin(*self.allowed_roles), c.cast(self.type_name))
                .otherwise(F.lit(self.mask_value).cast(self.type_name)))


# fixed values: the two policies of the reference
SIMPLE_MASK_STRING = MaskPolicy("simple_mask_string", "*** masked ***", "string")
SIMPLE_MASK_INT = MaskPolicy("simple_mask_int", -999, "int")

# fixed value: the columns the reference binds to a policy
TRIPS_STREAM_MASKS = {
    "bikeid": SIMPLE_MASK_INT,
    "birth_year": SIMPLE_MASK_INT,
    "gender": SIMPLE_MASK_INT,
    "usertype": SIMPLE_MASK_STRING,
}


#: Session setting that names the role of a session.
ROLE = "spokewise.role"


def use_role(spark: SparkSession, role: str) -> None:
    """``use role R``: the role of this session from now on."""
    spark.conf.set(ROLE, role.upper())


def current_role(spark: SparkSession) -> str:
    """``current_role()``; a session that never chose one is ``PUBLIC``, which no policy allows by itself."""
    return spark.conf.get(ROLE, "PUBLIC").upper()


def policies_to_text(policies: dict[str, MaskPolicy]) -> str:
    return json.dumps({c: asdict(p) for c, p in policies.items()})


def policies_of_text(text: str) -> dict[str, MaskPolicy]:
    return {c: MaskPolicy(**{**p, "allowed_roles": tuple(p["allowed_roles"])}) for c, p in json.loads(text).items()}


def apply_masks(df: DataFrame, policies: dict[str, MaskPolicy], role) -> DataFrame:
    cols = [policies[c].apply(F.col(c), role).alias(c) if c in policies else F.col(c) for c in df.columns]
    return df.select(*cols)


def per_role(df: DataFrame, roles: list[str], policies: dict[str, MaskPolicy]) -> DataFrame:
    """The table as each role sees it, in one scan: every row once per role, with a
    ``role`` column, masked by that role. Aggregating by ``role`` then compares roles
    without reading the table once per role."""
    tagged = df.select(F.explode(F.array(*[F.lit(r) for r in roles])).alias("role"), "*")
    cols = [F.col("role")] + [policies[c].apply(F.col(c), F.col("role")).alias(c) if c in policies
                              else F.col(c) for c in df.columns]
    return tagged.select(*cols)
