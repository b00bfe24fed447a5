"""tessera: profile nested documents and relational tables, find their keys
and links, and move data between the two shapes - all as Spark jobs.

Modules: ``sources`` (readers, writers, JDBC), ``functions`` (column
functions, JSON), ``operators`` (profiling, schema walk, reshaping,
relationships), ``plans`` (composite entry points M1-M4 and the registered
queries), ``streaming`` (M2 over a stream).
"""

__version__ = "0.1.0"
