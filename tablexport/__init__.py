"""tablexport: whole-database extraction to Avro, expressed as Spark jobs.

Entry points: ``tablexport.run.export_database`` (a whole export),
``tablexport.plans.chunks.plan_table`` (chunk a DataFrame),
``tablexport.sources`` (catalogs, JDBC chunk reads, the Avro data source).
"""

__version__ = "0.1.0"
