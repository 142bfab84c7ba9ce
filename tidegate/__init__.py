"""Daily snapshot loads and AML transfer review as PySpark DataFrame operators.

Layout:

* ``functions``  Column functions (text, numbers, dates, formats)
* ``operators``  DataFrame -> DataFrame operators, none of which runs a job
* ``sources``    file, reference and table readers and writers
* ``plans``      load, mart, spool and whole-day flows built from the operators
* ``streaming``  loads that start when ready files arrive
"""
