"""parlance: utterance-dataset analytics as Spark DataFrame jobs.

Sub-packages:

* ``sources``   – readers, writers and the derived input views.
* ``functions`` – Column-level building blocks (strict JSON, quoting, types).
* ``operators`` – the operators of the survey, one module per family.
* ``plans``     – composed jobs and the catalogue of registered queries.
* ``streaming`` – the stateless operators run on a streaming DataFrame.
"""

from parlance.config import Settings, prepare_session

__all__ = ["Settings", "prepare_session"]
