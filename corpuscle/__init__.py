"""Text-corpus and catalogue analytics written as Spark jobs.

Every public function takes DataFrames (plus small rule tables) and returns a
lazy DataFrame.  See README.md for the operator list.
"""
