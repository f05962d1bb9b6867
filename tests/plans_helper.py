"""What tests ask of plans."""


def plan_of(df):
    """Physical plan before it runs."""
    return df._jdf.queryExecution().executedPlan().toString()
