"""Public licence texts and the notices that name a licence."""

TEMPLATES: dict[str, list[str]] = {
    "AGPL-3.0": [
        "This work is licensed under the GNU Affero General Public License, version 3.",
        """This program is free software: you can redistribute it and/or modify it under the terms of
        the GNU Affero General Public License as published by the Free Software Foundation, either
        version 3 of the License, or (at your option) any later version.""",
        """The GNU Affero General Public License is a free, copyleft license for software and other
        kinds of works, specifically designed to ensure cooperation with the community in the case of
        network server software.""",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file
        except in compliance with the License. You may obtain a copy of the License at
        http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in
        writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT
        WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the
        specific language governing permissions and limitations under the License.""",
        """"License" shall mean the terms and conditions for use, reproduction, and distribution as
        defined by Sections 1 through 9 of this document. "Licensor" shall mean the copyright owner or
        entity authorized by the copyright owner that is granting the License.""",
    ],
    "BSD-2-Clause": [
        """Redistribution and use in source and binary forms, with or without modification, are
        permitted provided that the following conditions are met: 1. Redistributions of source code
        must retain the above copyright notice, this list of conditions and the following disclaimer.
        2. Redistributions in binary form must reproduce the above copyright notice, this list of
        conditions and the following disclaimer in the documentation and/or other materials provided
        with the distribution.""",
    ],
    "BSL-1.0": [
        "Distributed under the Boost Software License, Version 1.0.",
        """Permission is hereby granted, free of charge, to any person or organization obtaining a copy
        of the software and accompanying documentation covered by this license (the "Software") to use,
        reproduce, display, distribute, execute, and transmit the Software""",
    ],
    "BSD-3-Clause": [
        "Licensed under the BSD 3-Clause License.",
        """Redistribution and use in source and binary forms, with or without modification, are
        permitted provided that the following conditions are met: 1. Redistributions of source code
        must retain the above copyright notice, this list of conditions and the following disclaimer.
        2. Redistributions in binary form must reproduce the above copyright notice, this list of
        conditions and the following disclaimer in the documentation and/or other materials provided
        with the distribution. 3. Neither the name of the copyright holder nor the names of its
        contributors may be used to endorse or promote products derived from this software without
        specific prior written permission.""",
        """Neither the name of the copyright holder nor the names of its contributors may be used to
        endorse or promote products derived from this software without specific prior written
        permission.""",
    ],
    "CC-BY-4.0": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "CC-BY-SA-4.0": [
        "Licensed under CC BY-SA 4.0.",
        """This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International
        License.""",
    ],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.",
        """This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International
        License.""",
    ],
    "CC-BY-NC-SA-4.0": [
        "Licensed under CC BY-NC-SA 4.0.",
        """This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0
        International License.""",
    ],
    "CC0-1.0": [
        "To the extent possible under law, the author has waived all copyright and related rights.",
    ],
    "EPL-2.0": [
        """This program and the accompanying materials are made available under the terms of the
        Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/""",
    ],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        """This program is free software; you can redistribute it and/or modify it under the terms of
        the GNU General Public License as published by the Free Software Foundation; either version 2
        of the License, or (at your option) any later version.""",
        """The licenses for most software are designed to take away your freedom to share and change
        it. By contrast, the GNU General Public License is intended to guarantee your freedom to share
        and change free software--to make sure the software is free for all its users.""",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        """This program is free software: you can redistribute it and/or modify it under the terms of
        the GNU General Public License as published by the Free Software Foundation, either version 3
        of the License, or (at your option) any later version.""",
        """The GNU General Public License is a free, copyleft license for software and other kinds of
        works.""",
    ],
    "ISC": [
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or
        without fee is hereby granted, provided that the above copyright notice and this permission
        notice appear in all copies.""",
    ],
    "LGPL-2.1": [
        "This work is licensed under the GNU Lesser General Public License, version 2.1.",
        """This library is free software; you can redistribute it and/or modify it under the terms of
        the GNU Lesser General Public License as published by the Free Software Foundation; either
        version 2.1 of the License, or (at your option) any later version.""",
        """This license, the Lesser General Public License, applies to some specially designated
        software packages--typically libraries--of the Free Software Foundation and other authors who
        decide to use it.""",
    ],
    "LGPL-3.0": [
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        """This library is free software: you can redistribute it and/or modify it under the terms of
        the GNU Lesser General Public License as published by the Free Software Foundation, either
        version 3 of the License, or (at your option) any later version.""",
        """This version of the GNU Lesser General Public License incorporates the terms and conditions
        of version 3 of the GNU General Public License, supplemented by the additional permissions
        listed below.""",
    ],
    "MIT": [
        "Released under the MIT License.",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this
        software and associated documentation files (the "Software"), to deal in the Software without
        restriction, including without limitation the rights to use, copy, modify, merge, publish,
        distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the
        Software is furnished to do so, subject to the following conditions: The above copyright
        notice and this permission notice shall be included in all copies or substantial portions of
        the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
        IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A
        PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE
        LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
        OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER
        DEALINGS IN THE SOFTWARE.""",
    ],
    "MPL-2.0": [
        """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a
        copy of the MPL was not distributed with this file, You can obtain one at
        https://mozilla.org/MPL/2.0/.""",
        """"Contributor" means each individual or legal entity that creates, contributes to the creation
        of, or owns Covered Software.""",
    ],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain.",
    ],
}
