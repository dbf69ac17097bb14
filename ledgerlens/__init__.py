"""ledgerlens: labelled transaction-graph analytics as Spark DataFrame plans.

Every operator takes DataFrames and returns a lazy DataFrame; nothing calls an
action unless an estimator has to fit.  Subpackages:

* ``sources``   - table schemas, catalog/loading, sinks, test-table derivations
* ``functions`` - Column-level rules (class labels, case / cluster types, bins)
* ``operators`` - relational, windowed and ML operators
* ``plans``     - the named query registry and its DuckDB oracle SQL
* ``streaming`` - intentionally empty (the analysed workload is batch only)
"""

__version__ = "0.1.0"
