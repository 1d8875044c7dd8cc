"""User registration as a batch (V1, D5, D9, U1) and the login lookup (F2).

Requests are checked in order: form rules first (required fields, e-mail
shape), then uniqueness of username and e-mail against existing users and
earlier accepted requests, exactly as one-by-one inserts would decide.
Accepted users are appended with the default role; passwords are not
carried into the table (credential handling is not data work).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.functions import values as V
from folio.operators import validate as VAL
from folio.operators.search import lookup_natural_key
from folio.operators.unique import unique_insert_two_keys

USER_COLUMNS = ["username", "email", "role"]


def register_users(users: DataFrame, requests: DataFrame, order_col: str = "seq") -> tuple[DataFrame, DataFrame]:
    """(users with the accepted requests appended, rejected requests with a reason).

    ``requests`` has ``order_col, username, email, password``.
    """
    checked = VAL.with_reasons(requests, VAL.user_rules())
    valid = checked.filter(F.col("n_reasons") == 0).drop("reasons", "n_reasons")
    invalid = checked.filter(F.col("n_reasons") > 0).select(order_col, "username", "email", "reasons")
    decided = unique_insert_two_keys(valid, ("username", "email"), order_col, existing=users)
    accepted = decided.filter("accepted").select("username", "email", F.lit(V.DEFAULT_ROLE).alias("role"))
    taken = decided.filter(~F.col("accepted")).select(
        order_col, "username", "email", F.lit("username or email already exists").alias("reasons"))
    return users.select(*USER_COLUMNS).unionByName(accepted), invalid.unionByName(taken)


def role_of(users: DataFrame, email: str) -> DataFrame:
    """the role of the user with this e-mail (empty when none)."""
    return lookup_natural_key(users, "email", email, ["role"])
