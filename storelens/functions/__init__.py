from storelens.functions.columns import (  # noqa: F401
    MONEY,
    MONEY_SUM,
    as_double,
    avg_money,
    avg_num,
    count_distinct,
    count_if,
    count_when,
    dow,
    fixed,
    hour,
    money,
    money_sum,
    pct,
    rank_desc,
    ratio,
    tier,
    ts_lit,
    whole_days,
)
