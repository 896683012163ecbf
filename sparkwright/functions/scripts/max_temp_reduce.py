"""Reduce script: 'key<TAB>value' lines clustered by key -> 'key<TAB>max'."""
import sys
from itertools import groupby

rows = (line.rstrip("\n").split("\t") for line in sys.stdin)
for key, group in groupby(rows, key=lambda row: row[0]):
    print(key, repr(max(float(row[1]) for row in group)), sep="\t")
