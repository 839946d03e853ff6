"""Writers: archive, encoded lines, events, remediation, models' inputs, topology."""
