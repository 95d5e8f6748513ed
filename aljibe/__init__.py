"""aljibe: PySpark operators for layered data pipelines.

Every operator is a plain function from DataFrame to DataFrame, usable with
``df.transform(op, ...)``, and stays lazy until a sink. The few functions that
run a job (gates, watermarks, quantile narrowing) read control values only and
say so in their docstring.
"""
