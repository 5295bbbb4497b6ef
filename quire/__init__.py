"""quire: a knowledge-corpus engine written as Spark DataFrame / SQL /
Structured Streaming jobs.

Every public operator is a ``DataFrame -> DataFrame`` function (usable with
``df.transform``) built from native Column expressions, so Catalyst can push
filters and prune columns and whole-stage codegen keeps the work in the JVM.
Python rows appear only where a user-supplied model is called
(``operators.infer``) and in the stateful page-carry stream.
"""

__version__ = "0.1.0"
