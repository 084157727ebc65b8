def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
