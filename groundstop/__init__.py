"""groundstop - flight-cancellation analytics, sampling, scoring and monitoring on Spark.

Every public function takes DataFrames (or a SparkSession for I/O) and
returns a DataFrame.  No function creates a session, collects a table to
the driver or registers a Python UDF: the work is declared with the
DataFrame / SQL API and planned by Catalyst.

Sub-packages:

* ``sources``   - CSV / catalog readers and writers (explicit schemas, no inference)
* ``functions`` - column expressions (dates, HHMM times, route keys, hash sampling)
* ``operators`` - DataFrame -> DataFrame operators (ingest, rates, profile,
  sampling, features, report, monitor, registry, scoring, model)
* ``plans``     - the registered queries and their SQL oracles
* ``streaming`` - the prediction log as a Structured Streaming job
"""

__version__ = "0.1.0"
