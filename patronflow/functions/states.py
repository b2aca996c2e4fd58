"""Order-state and device classification."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._cols import ColumnLike, as_col

# Order states that do not count as a valid order.
INVALID_STATES = ("new", "payment_authorisation_error", "canceled", "reserved")
COMPLETED = "completed"
CANCELED = "canceled"


def is_valid(state: ColumnLike) -> Column:
    """1 for a valid order, 0 otherwise; a NULL state is valid."""
    return F.when(as_col(state).isin(*INVALID_STATES), 0).otherwise(1)


def valid_only(state: ColumnLike) -> Column:
    """:func:`is_valid` as a filter, in a form a scan can push down."""
    state = as_col(state)
    return state.isNull() | ~state.isin(*INVALID_STATES)


def is_open(state: ColumnLike) -> Column:
    """0 once an order is canceled or completed, 1 before; NULL is open."""
    return F.when(as_col(state).isin(CANCELED, COMPLETED), 0).otherwise(1)


def is_canceled(state: ColumnLike) -> Column:
    return F.when(as_col(state) == CANCELED, 1).otherwise(0)


def device_class(user_agent: ColumnLike) -> Column:
    """App or web by user agent. Android wins over iPhone, NULL stays NULL."""
    user_agent = as_col(user_agent)
    return (F.when(user_agent.contains("Android"), "android app")
            .when(user_agent.contains("iPhone"), "iOS app")
            .when(user_agent.isNotNull(), "web app"))
