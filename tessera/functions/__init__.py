"""Column-expression helpers. Every helper returns a built-in Spark
expression (no Python UDF). Those with lambdas (``vectors``) are evaluated
by the interpreter of higher-order functions, the rest in generated code."""
