"""Reading and writing: delimited files, requests, stored artifacts, run registry."""
