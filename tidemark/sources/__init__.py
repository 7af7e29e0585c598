"""Where data comes from: checkpoint archives and directories, account records, lists of tokens, programs."""
