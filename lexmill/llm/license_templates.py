"""The license templates shipped with the scan: whole texts, file headers and common wordings, as a small bounded table.

Whole texts lie in ``license_texts``, a file per license without copyright line. A license has several templates.
"""

from __future__ import annotations

from pathlib import Path

_TEXTS = Path(__file__).with_name("license_texts")
_FILES = {
    "0BSD": "0bsd", "Apache-2.0": "apache-2.0", "Artistic": "artistic-1.0", "BSD-2-Clause": "bsd-2-clause",
    "BSD-3-Clause": "bsd-3-clause", "BSL-1.0": "bsl-1.0", "CC0-1.0": "cc0-1.0", "GFDL-1.2": "gfdl-1.2", "GFDL-1.3": "gfdl-1.3",
    "GPL-1": "gpl-1.0", "GPL-2": "gpl-2.0", "GPL-3": "gpl-3.0", "ISC": "isc", "LGPL-2": "lgpl-2.0", "LGPL-2.1": "lgpl-2.1",
    "LGPL-3": "lgpl-3.0", "MIT": "mit", "MPL-1.1": "mpl-1.1", "MPL-2.0": "mpl-2.0", "Unlicense": "unlicense",
}

# Short enough that another version misses more than a fifth of the shingles.
_GNU = (
    ("gpl", "GNU General Public License", "GNU General Public License", "GPL", ("2", "3")),
    ("lgpl", "GNU Lesser General Public License", "Lesser General Public License", "LGPL", ("2.1", "3")),
    ("agpl", "GNU Affero General Public License", "Affero General Public License", "AGPL", ("3",)),
)


def _gnu() -> list[tuple[str, str]]:
    out = []
    for family, name, end, short, versions in _GNU:
        for version in versions:
            license_id = family + "-" + (version if "." in version else version + ".0")
            out += [
                (license_id, f"{end} as published by the Free Software Foundation, either version {version} of the"),
                (license_id, f"{end}, version {version}"),
                (license_id, f"{name} v{version}"),
                (license_id, f"under the GNU {short} v{version}"),
                (license_id, f"GNU {short} version {version}"),
                (license_id, f"licensed under the {short}v{version}"),
                (license_id, f"licensed under {short}v{version}"),
                (license_id, f"SPDX-License-Identifier: {license_id.upper()}"),
            ]
    return out


def _creative_commons() -> list[tuple[str, str]]:
    out = []
    for short, name in (
        ("by", "Attribution"), ("by-sa", "Attribution-ShareAlike"), ("by-nc", "Attribution-NonCommercial"),
        ("by-nd", "Attribution-NoDerivatives"), ("by-nc-sa", "Attribution-NonCommercial-ShareAlike"),
        ("by-nc-nd", "Attribution-NonCommercial-NoDerivatives"),
    ):
        for version, port in (("4.0", "International"), ("3.0", "Unported")):
            license_id, words = f"cc-{short}-{version}", short.upper()
            out += [
                (license_id, f"under a Creative Commons {name} {version} {port} License."),
                (license_id, f"under the Creative Commons {name} {version} {port} License."),
                (license_id, f"Creative Commons {name} {version}"),
                (license_id, f"licensed under CC {words} {version}."),
                (license_id, f"available under CC {words} {version}"),
                (license_id, f"SPDX-License-Identifier: CC-{words}-{version}"),
                (license_id, f"http://creativecommons.org/licenses/{short}/{version}/"),
            ]
    return out


#: (license, wordings): short notices need every one or nearly every one of their shingles.
_WORDINGS: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("apache-2.0", (
        "licensed under the Apache License 2.0",
        "licensed under the Apache License, Version 2.0",
        "under the terms of the Apache License, Version 2.0",
        "under the terms of the Apache License 2.0",
        "released under the Apache License 2.0",
        "released under the Apache License, Version 2.0",
        "distributed under the Apache License, Version 2.0",
        "licensed under Apache 2.0",
        "licensed under the Apache 2.0 license",
        "released under the Apache 2.0 license",
        "Apache License Version 2.0, January 2004",
        "SPDX-License-Identifier: Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the '
        "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable "
        'law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES '
        "OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and "
        "limitations under the License.",
    )),
    ("mit", (
        "licensed under the MIT License",
        "distributed under the MIT License",
        "available under the MIT License",
        "provided under the MIT License",
        "under the terms of the MIT License",
        "licensed under the terms of the MIT license",
        "licensed under MIT",
        "under an MIT license",
        "governed by an MIT-style license",
        "The MIT License (MIT)",
        "SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
        'files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, '
        "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
        "Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice "
        "shall be included in all copies or substantial portions of the Software.",
    )),
    ("mpl-2.0", (
        "subject to the terms of the Mozilla Public License, v. 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed "
        "with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
        "licensed under the Mozilla Public License 2.0",
        "licensed under the Mozilla Public License, version 2.0",
        "under the terms of the Mozilla Public License, version 2.0",
        "SPDX-License-Identifier: MPL-2.0",
    )),
    ("bsd", (
        "governed by a BSD-style license",
        "licensed under the BSD license",
        "released under the BSD license",
        "distributed under the BSD license",
        "under the terms of the BSD license",
        "under a BSD license",
    )),
    ("bsd-2-clause", (
        "BSD 2-Clause License",
        "under the 2-clause BSD license",
        "Simplified BSD License",
        "SPDX-License-Identifier: BSD-2-Clause",
    )),
    ("bsd-3-clause", (
        "BSD 3-Clause License",
        "under the 3-clause BSD license",
        "New BSD License",
        "SPDX-License-Identifier: BSD-3-Clause",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived "
        "from this software without specific prior written permission.",
    )),
    ("isc", (
        "licensed under the ISC License",
        "released under the ISC License",
        "under the terms of the ISC License",
        "SPDX-License-Identifier: ISC",
    )),
    ("bsl-1.0", (
        "Distributed under the Boost Software License, Version 1.0.",
        "licensed under the Boost Software License 1.0",
        "Boost Software License Version 1.0",
        "SPDX-License-Identifier: BSL-1.0",
    )),
    ("epl-2.0", (
        "licensed under the Eclipse Public License 2.0",
        "under the terms of the Eclipse Public License v. 2.0",
        "SPDX-License-Identifier: EPL-2.0",
    )),
    ("cc0-1.0", (
        "CC0 1.0 Universal",
        "under the CC0 1.0",
        "SPDX-License-Identifier: CC0-1.0",
        "http://creativecommons.org/publicdomain/zero/1.0/",
    )),
    ("unlicense", (
        "This is free and unencumbered software released into the public domain.",
        "SPDX-License-Identifier: Unlicense",
    )),
    ("0bsd", ("SPDX-License-Identifier: 0BSD",)),
)


def shipped() -> list[tuple[str, str]]:
    """(license_id, text) of every template but the short notices of ``licenses.NOTICES``."""
    whole = [(license_id, (_TEXTS / file).read_text(encoding="utf-8")) for file, license_id in sorted(_FILES.items())]
    worded = [(license_id, text) for license_id, texts in _WORDINGS for text in texts]
    return [*whole, *worded, *_gnu(), *_creative_commons()]
