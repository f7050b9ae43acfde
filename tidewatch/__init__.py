"""Monthly outlier detection over wide fact tables, Spark first.

``tidewatch.plans.pipelines`` has the entry points, ``tidewatch.config`` the
parameters; operators are pure DataFrame-to-DataFrame functions.
"""
