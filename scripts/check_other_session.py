"""Oracle check under a differently configured session (200 shuffle partitions, ANSI and AQE
off, New York session zone).  Run with TZ=America/New_York to also move the client zone."""
import sys
import os
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from pyspark.sql import SparkSession
import scripts.check_oracle as C
import stratus.session as S

def other_session(*a, **k):
    s = (SparkSession.builder.master("local[4]").appName("other")
         .config("spark.sql.shuffle.partitions", "200")
         .config("spark.sql.ansi.enabled", "false")
         .config("spark.sql.adaptive.enabled", "false")
         .config("spark.sql.session.timeZone", "America/New_York")
         .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    return s

S.build_session = other_session
sys.argv = ["x", "/root/testdata/sf0.01"] + sys.argv[1:]
C.main()
