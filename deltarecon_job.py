"""spark-submit entry point: ``spark-submit [confs] deltarecon_job.py <command> [args]``.

Ship the package with ``--py-files deltarecon.zip`` (zip of the deltarecon/
folder). Commands are those of ``deltarecon.cli``.
"""

import sys

from deltarecon.cli import main

if __name__ == "__main__":
    main(sys.argv[1:])
