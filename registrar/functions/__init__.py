"""Column-expression helpers. Everything here returns a ``Column``: the work
stays inside whole-stage codegen, no Python UDF is involved."""
