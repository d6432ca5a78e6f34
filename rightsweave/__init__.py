"""rightsweave: rights-chain analytics as Spark DataFrame jobs.

Sub-packages:

* ``sources``   – readers, writers, schema registry, the demo world derived
                  from the benchmark tables.
* ``functions`` – Column-level helpers (array sets, restriction meet,
                  percent product, date combination).
* ``operators`` – reusable DataFrame operators (filters, projections,
                  joins, grouped statistics).
* ``plans``     – the three domain jobs: territories, contract chains,
                  restitution of shares.
* ``streaming`` – intentionally empty: the modelled application is batch only.
"""

from rightsweave.session import build_session, scratch_dir

__all__ = ["build_session", "scratch_dir"]
