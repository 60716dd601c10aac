"""E-commerce event analytics as plain Spark jobs.

Messages are routed into raw tables (``streaming``), cleaned and upserted into
a typed star (``plans.dds``), aggregated into nine marts (``plans.marts``) and
published (``plans.publish``).  Everything is DataFrame -> DataFrame.
"""
