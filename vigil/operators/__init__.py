"""The measures: completeness, timeliness and accuracy, each DataFrame(s) + rules -> DataFrame."""
